"""A topic kept in files, behind Spark's own Python data source.

It has the columns, the options and the offsets of the Kafka source, so that everything that reads or writes a
topic can run where no broker is: ``read_stream``, ``read_topic_bounded`` and ``write_topic`` take ``format="filetopic"``
and a folder in place of the servers. The folder must be one that the driver and all executors mount.

``<folder>/<topic>/<partition>/<first offset>-<messages>.jsonl`` is a segment, one message a line. Tasks write
segments aside, and the driver gives them their offsets when the job commits, so a failed job leaves no message.
A task reads one segment at a time, or the part of it that was asked for.
"""

from __future__ import annotations

import base64
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

NAME = "filetopic"
SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
HEADERS = ", headers array<struct<key: string, value: binary>>"
DEFAULT_PARTITIONS = 10
# Messages that a writing task holds before it adds to its segments.
HELD = 10_000


def register_file_topic(spark: SparkSession) -> None:
    """Make the format known to a session; workers find this package where the driver does."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    spark.dataSource.register(FileTopic)


@dataclass
class Span(InputPartition):
    """Offsets from ``start`` to before ``end`` of one segment."""

    path: str
    partition: int
    first: int
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    """Segments that a task has written aside: (partition, path, messages)."""

    segments: list[tuple[int, str, int]]


class Topic:
    def __init__(self, options: dict[str, str]):
        self.name = options.get("subscribe") or options["topic"]
        self.folder = os.path.join(options["kafka.bootstrap.servers"], self.name)
        self.count = int(options.get("partitions", DEFAULT_PARTITIONS))
        self.headers = options.get("includeHeaders", "false").lower() == "true"

    def segments(self, partition: int) -> list[tuple[int, int, str]]:
        """(first offset, offset behind the last, path), in order."""
        folder = os.path.join(self.folder, str(partition))
        found = []
        for name in os.listdir(folder) if os.path.isdir(folder) else ():
            if name.endswith(".jsonl"):
                first, messages = map(int, name.removesuffix(".jsonl").split("-"))
                found.append((first, first + messages, os.path.join(folder, name)))
        return sorted(found)

    def ends(self) -> dict[str, int]:
        """The offset behind the last message of each partition."""
        known = [int(p) for p in os.listdir(self.folder) if p.isdigit()] if os.path.isdir(self.folder) else []
        return {str(p): max([end for _, end, _ in self.segments(p)], default=0) for p in sorted({*known, *range(self.count)})}

    def offsets(self, text: str) -> dict[str, int]:
        """The offsets that an option names: earliest, latest, or JSON by topic and partition (-2 earliest, -1 latest)."""
        ends = self.ends()
        if text in ("earliest", "latest"):
            return dict.fromkeys(ends, 0) if text == "earliest" else ends
        given = json.loads(text)[self.name]
        special = {-2: lambda p: 0, -1: lambda p: ends[p]}
        return {p: special.get(given.get(p, -2), lambda p: given[p])(p) for p in ends}

    def spans(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        out = []
        for p in end:
            low, high = start.get(p, 0), end[p]
            for first, behind, path in self.segments(int(p)):
                if max(low, first) < min(high, behind):
                    out.append(Span(path, int(p), first, max(low, first), min(high, behind)))
        return out

    def read(self, span: Span) -> Iterator[tuple]:
        with open(span.path, encoding="utf-8") as lines:
            for offset, line in enumerate(lines, span.first):
                if offset >= span.end:
                    return
                if offset >= span.start:
                    message = json.loads(line)
                    key, value = (from_text(message[n]) for n in ("key", "value"))
                    at = datetime.fromtimestamp(message["ms"] / 1000, timezone.utc)
                    row = key, value, self.name, span.partition, offset, at, 0
                    headers = message.get("headers")
                    yield (*row, headers and [(k, from_text(v)) for k, v in headers]) if self.headers else row


def from_text(text: str | None) -> bytes | None:
    return None if text is None else base64.b64decode(text)


def to_text(value: str | bytes | None) -> str | None:
    raw = value.encode() if isinstance(value, str) else value
    return None if raw is None else base64.b64encode(raw).decode()


class FileTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA + (HEADERS if Topic(self.options).headers else "")

    def reader(self, schema) -> DataSourceReader:
        return Bounded(Topic(self.options), self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Stream(Topic(self.options), self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return Writer(Topic(self.options))


class Bounded(DataSourceReader):
    def __init__(self, topic: Topic, options: dict[str, str]):
        self.topic = topic
        self.start = topic.offsets(options.get("startingOffsets", "earliest"))
        self.end = topic.offsets(options.get("endingOffsets", "latest"))

    def partitions(self) -> list[Span]:
        return self.topic.spans(self.start, self.end) or [Span("", 0, 0, 0, 0)]

    def read(self, span: Span) -> Iterator[tuple]:
        return self.topic.read(span) if span.path else iter(())


class Stream(DataSourceStreamReader):
    """``maxOffsetsPerTrigger`` bounds a micro-batch.

    Spark asks a Python source how far to go without saying how far it is, so a bound needs a place where the
    source notes that itself: the option ``progress``, a file beside the stream's checkpoint folder.
    """

    def __init__(self, topic: Topic, options: dict[str, str]):
        self.topic = topic
        self.starting = options.get("startingOffsets", "latest")
        most, self.progress = options.get("maxOffsetsPerTrigger"), options.get("progress")
        self.most = None if most is None else int(most)
        if self.most is not None and not self.progress:
            raise ValueError("a bound on the messages of a micro-batch needs the option progress")

    def initialOffset(self) -> dict:
        return self.topic.offsets(self.starting)

    def reached(self) -> dict[str, int]:
        if not os.path.exists(self.progress):
            self.note(self.initialOffset())
        with open(self.progress, encoding="utf-8") as noted:
            return json.load(noted)

    def note(self, offsets: dict[str, int]) -> None:
        with open(f"{self.progress}.new", "w", encoding="utf-8") as out:
            json.dump(offsets, out)
        os.replace(f"{self.progress}.new", self.progress)

    def latestOffset(self) -> dict:
        ends = self.topic.ends()
        if self.most is None:
            return ends
        reached = self.reached()
        waiting = {p: max(0, e - reached.get(p, 0)) for p, e in ends.items()}
        whole = max(1, sum(waiting.values()))
        # shares by what waits; what rounding leaves goes to the first partitions that have more
        share = {p: min(w, w * self.most // whole) for p, w in waiting.items()}
        left, out = self.most - sum(share.values()), {}
        for p, w in waiting.items():
            more = min(left, w - share[p])
            left -= more
            out[p] = reached.get(p, 0) + share[p] + more
        return out

    def partitions(self, start: dict, end: dict) -> list[Span]:
        if self.most is not None:
            self.note(end)
        return self.topic.spans(start, end)

    def read(self, span: Span) -> Iterator[tuple]:
        return self.topic.read(span)


class Writer(DataSourceWriter):
    """Messages go to the partition of their key's hash; those without a key stay together in a task."""

    def __init__(self, topic: Topic):
        self.topic = topic

    def write(self, rows: Iterator) -> Written:
        own = uuid.uuid4().hex
        held: dict[int, list[str]] = {}
        counts: dict[int, int] = {}

        def path(partition: int) -> str:
            return os.path.join(self.topic.folder, str(partition), f".{own}")

        def flush() -> None:
            for partition, lines in held.items():
                os.makedirs(os.path.dirname(path(partition)), exist_ok=True)
                with open(path(partition), "a", encoding="utf-8") as out:
                    out.writelines(lines)
                counts[partition] = counts.get(partition, 0) + len(lines)
            held.clear()

        size, now = 0, int(datetime.now(timezone.utc).timestamp() * 1000)
        for row in rows:
            message = {"key": to_text(row["key"]), "value": to_text(row["value"]), "ms": now}
            if "headers" in row and row["headers"]:
                message["headers"] = [(h["key"], to_text(h["value"])) for h in row["headers"]]
            partition = zlib.crc32((message["key"] or own).encode()) % self.topic.count
            held.setdefault(partition, []).append(json.dumps(message) + "\n")
            size += 1
            if size % HELD == 0:
                flush()
        flush()
        return Written([(p, path(p), n) for p, n in sorted(counts.items())])

    def commit(self, messages: list[Written | None]) -> None:
        ends = self.topic.ends()
        for written in messages:
            for partition, path, count in written.segments if written else ():
                first = ends.get(str(partition), 0)
                os.rename(path, os.path.join(os.path.dirname(path), f"{first:020d}-{count}.jsonl"))
                ends[str(partition)] = first + count

    def abort(self, messages: list[Written | None]) -> None:
        for written in messages:
            for _, path, _ in written.segments if written else ():
                os.remove(path)
