"""Mixture-controlled packing: deficit round-robin over source queues.

The documents of a source form a queue of tokens. Round n serves each queue its quantum, the whole tokens of its
share per round, and carries the fraction as its deficit into the next: after n of R rounds a queue of T tokens
has given floor(T n / R). So no state passes from round to round, and any task can name the round and place of
any token. The rounds follow each other without a gap and windows cut that stream every `window` tokens: a window spans one
whole turn of the queues, in the middle of two rounds or not, and holds each source within a few tokens of its share.
Only the last window is not full.

Shares are the queues' sizes, or follow `weights`; then a queue that runs dry ends a phase, and the rest share on.
Sources with less than one 64th of all tokens share a queue, and within it they are served in the same way: as many rounds, each
with the whole tokens of a source's share, so sources of less than one token a round are served in some rounds only. Sources start
with different fractions, spread evenly, so that rounds are of nearly one length and small sources do not all meet in one round.

Cases: a null text is the empty text and still has its end token. A null source is a source of its own. Rows that
repeat are packed each. Order within a queue is that of the stored rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from trackloom.llm.common import as_bytes, batch, map_batches, settle
from trackloom.llm.tokens import vocabulary, word_tokenizer

WINDOW = 4096
END = 2
VOCABULARY = "word_bpe_49k.json"
#: Texts that are tokenized together.
ROWS = 1000
SHARE = 64


def tokenize(docs: DataFrame, id_col: str, text_col: str, source_col: str, path: str) -> DataFrame:
    """(id, source, task, start, tokens, ids): ids as bytes, two a piece if the vocabulary allows; start counts the tokens before in this task and source.

    Settled before anything depends on which task read which rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, coder, before = TaskContext.get().partitionId(), word_tokenizer(path), {}
        end = np.array([END], dtype=coder.kind).tobytes()
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                sources, starts, ids = part.column(1).to_pylist(), [], []
                for source, found in zip(sources, coder.encode(as_bytes(part.column(2))), strict=True):
                    starts.append(before.get(source, 0))
                    before[source] = starts[-1] + len(found) + 1
                    ids.append(found.tobytes() + end)
                yield batch(
                    {
                        "id": (part.column(0).to_pylist(), pa.int64()),
                        "source": (sources, pa.string()),
                        "task": ([task] * len(ids), pa.int32()),
                        "start": (starts, pa.int64()),
                        "tokens": ([len(x) // len(end) for x in ids], pa.int64()),
                        "ids": (ids, pa.binary()),
                    }
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    return settle(map_batches(rows, run, "id long, source string, task int, start long, tokens long, ids binary"), "tokens")


class Schedule:
    """Where each token of each queue goes.

    queues: tokens per queue, in serving order; weights: serving rates (default: the sizes themselves); rounds: of
    the only phase without weights (default: one a window). A phase is (first position, rounds, tokens of each queue
    before it, tokens of each queue in it).
    """

    #: Numbers of served tokens that are held at most.
    HELD = 1 << 20

    def __init__(self, queues: list[int], weights: list[float] | None = None, window: int = WINDOW, rounds: int | None = None):
        self.phases: list[tuple[int, int, list[int], list[int]]] = []
        self.held: dict[tuple[int, int], np.ndarray] = {}
        rates = [float(q) for q in queues] if weights is None else weights
        left, given, position = list(queues), [0] * len(queues), 0
        while any(left):
            dry = min(n / r if r > 0 else math.inf for n, r in zip(left, rates, strict=True) if n)
            if weights is None or math.isinf(dry):
                take = list(left)
            else:
                take = [n if r > 0 and n / r <= dry else min(n, int(r * dry)) for n, r in zip(left, rates, strict=True)]
            self.phases.append((position, rounds or max(1, -(-sum(take) // window)), list(given), take))
            position += sum(take)
            left = [a - b for a, b in zip(left, take, strict=True)]
            given = [a + b for a, b in zip(given, take, strict=True)]

    def served(self, phase: int, n: int) -> np.ndarray:
        """Tokens of all queues before each queue, served in the first n rounds; the last number is that of all queues."""
        if (phase, n) not in self.held:
            _, rounds, _, take = self.phases[phase]
            if len(self.held) * len(take) > self.HELD:
                self.held.clear()
            t, first = np.array(take, dtype=np.int64), np.arange(len(take)) * rounds // len(take)
            # not t * n, which may pass 64 bits
            of_each = t // rounds * n + (t % rounds * n + first) // rounds
            self.held[phase, n] = np.concatenate([[0], np.cumsum(of_each)])
        return self.held[phase, n]

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int]]:
        """(position in the stream, length) of the runs of a document's tokens, in order."""
        end = start + length
        for phase, (first, rounds, before, take) in enumerate(self.phases):
            a, b = max(start, before[queue]) - before[queue], min(end, before[queue] + take[queue]) - before[queue]
            lead = queue * rounds // len(take)
            while a < b:
                n = ((a + 1) * rounds - 1 - lead) // take[queue]  # the round that serves token a
                now, then = self.served(phase, n), self.served(phase, n + 1)
                own, stop = int(now[queue + 1] - now[queue]), min(b, int(then[queue + 1] - then[queue]))
                yield first + int(now[-1] + then[queue] - now[queue]) + a - own, stop - a
                a = stop


def plan_queues(totals: dict[str | None, int], weights: dict[str | None, float] | None) -> tuple[dict[str | None, int], list[list[str | None]]]:
    """Queue number of each source, and the sources of each queue in order; those of one queue are served in turn too."""
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    whole = sum(totals.values())
    large = [s for s in names if weights is not None or totals[s] * SHARE >= whole]
    small = [s for s in names if s not in set(large)]
    queues = [[s] for s in large] + ([small] if small else [])
    return {s: k for k, q in enumerate(queues) for s in q}, queues


class Sources:
    """Where each token of each source goes: the schedule of the queues, and one for the sources within each queue."""

    def __init__(self, totals: dict[str | None, int], weights: dict[str | None, float] | None, window: int):
        self.queue_of, queues = plan_queues(totals, weights)
        rates = None if weights is None else [sum(weights.get(s, 0.0) for s in q) for q in queues]
        self.queues = Schedule([sum(totals[s] for s in q) for q in queues], rates, window)
        rounds = self.queues.phases[0][1] if self.queues.phases else 1
        self.within = [Schedule([totals[s] for s in q], rounds=rounds) if len(q) > 1 else None for q in queues]
        self.place_of = {s: k for q in queues for k, s in enumerate(q)}

    def pieces(self, source: str | None, start: int, length: int) -> Iterator[tuple[int, int]]:
        queue = self.queue_of[source]
        within = self.within[queue]
        for at, n in [(start, length)] if within is None else within.pieces(self.place_of[source], start, length):
            yield from self.queues.pieces(queue, at, n)


def sequences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    window: int = WINDOW,
    weights: dict[str | None, float] | None = None,
    vocabulary_path: str | None = None,
) -> DataFrame:
    """Pieces of all documents: id, start, length, ids, doc_tokens, sequence_id, offset, source.

    `ids` are a piece's tokens, four bytes each, the least first. The texts are tokenized once, without an exchange, and
    settled. What crosses to the driver is one number per source; what is joined back is one number per source and task.
    """
    tokens = tokenize(docs, id_col, text_col, source_col, vocabulary_path or vocabulary(VOCABULARY))
    by_task = tokens.groupBy("source", "task").agg(F.sum("tokens").alias("n"))
    totals = {r["source"]: r["n"] for r in by_task.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    sources = Sources(totals, weights, window)

    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select(F.col("source").alias("of"), F.col("task").alias("by"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # settled, so that its size is known and a small one is sent to the tokens instead of exchanging them
    bases = settle(bases, "token-bases")
    placed = tokens.join(bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("task") == F.col("by")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for b in batches:
            for doc, source, start, count, ids in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                done, view = 0, np.frombuffer(ids, dtype=f"<u{len(ids) // count}").astype("<u4")
                for position, length in sources.pieces(source, start, count):
                    while length:
                        part = min(length, window - position % window)
                        out.append((doc, done, part, view[done : done + part].tobytes(), count, position // window, position % window, source))
                        done, position, length, size = done + part, position + part, length - part, size + 4 * part
                        if len(out) == 10_000 or size >= BATCH:
                            yield pieces_of(out)
                            out, size = [], 0
        if out:
            yield pieces_of(out)

    rows = placed.select("id", "source", (F.col("start") + F.col("base")).alias("start"), "tokens", "ids")
    schema = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, source string"
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)


def pack(docs: DataFrame, id_col: str = "doc_id", *args, **options) -> DataFrame:
    """The pieces of `sequences`, with the digest ids_crc32 in place of the ids."""
    names = [id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"]
    return sequences(docs, id_col, *args, **options).select(*names)


PIECE = {
    "id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(), "offset": pa.int64(), "source": pa.string(),
}
#: Bytes of ids that are sent on together.
BATCH = 4 << 20


def pieces_of(rows: list[tuple]) -> pa.RecordBatch:
    return batch({name: (list(values), kind) for (name, kind), values in zip(PIECE.items(), zip(*rows, strict=True), strict=True)})
