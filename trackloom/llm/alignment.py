"""Alignment of two tokenizers over a corpus, by external spill counting.

A text is cut where tokens of A and of B end together; the last tokens of such a group are linked. What a link is worth depends on
how often its id pair is linked in the whole corpus, and whether any other pair of its B id is linked more often.

* Spill: documents are tokenized once, in blocks. The pair-document records of a block are parted by the radix of the B id and
  written as runs: pairs by B id, then A id, with their counts, in frames compressed by zstd; and with each pair the documents that hold it.
* Count: the runs of a radix are merged by a heap, a frame of each at a time, `FAN` runs a task and level after level,
  until there is one. Each level adds up equal pairs, so a merged run is bounded by the vocabularies and not by the data. In the last one
  all pairs of a B id follow each other: its maximum is known when the next B id comes.
* Stream back: the records of `TOGETHER` blocks and a radix meet the radix' counts and give one sum a document. A block adds up its radixes.

A B id or a pair that stands in every document is one entry a block, and a group of copies only adds to counts, so no task
sees more of them than of others. What is exchanged are runs and sums, never texts or single links.

Cases: a text that is null or empty, or that a vocabulary's tokens do not spell byte by byte (B cannot hold U+2581), has no tokens: zeros and
an empty string. Rows that share an id or a text count each; a null id stays null. Special tokens within a text are plain text.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.aligned import aligner
from trackloom.llm.common import give_back, importable, map_batches, settle
from trackloom.llm.packed import from_owners, owners
from trackloom.llm.tokens import vocabulary

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Parts by the B id's low bits.
RADIX = 64
#: A block ends with so many documents, or so many links.
DOCS, LINKS = 2048, 1 << 21
#: Pairs in a frame.
FRAME = 8192
#: Runs that a task merges, and blocks whose records meet the counts in one.
FAN, TOGETHER = 32, 1024
#: Texts that are tokenized together.
TEXTS = 500

ROWS = "block long, place int, id long, n_a long, n_b long, n_groups long, groups_sha256 string, radix int, frames array<binary>, records array<binary>"
RUN = "radix int, block long, frames array<binary>"
SUMS = "block long, best binary, counts binary"
RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers, column after column, compressed."""
    parts = [owners(c.astype(np.int64)) for c in columns]
    return zstandard.compress(b"".join(len(p).to_bytes(8, "little") + p for p in parts), 3)


def unpacked(raw: bytes) -> list[np.ndarray]:
    raw, out, at = zstandard.decompress(raw), [], 0
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 8], "little")
        out.append(from_owners(raw[at + 8 : at + 8 + size]))
        at += 8 + size
    return out


def framed(*columns: np.ndarray) -> list[bytes]:
    return [packed(*(c[at : at + FRAME] for c in columns)) for at in range(0, len(columns[0]), FRAME)]


def steps_of(values: np.ndarray) -> np.ndarray:
    """Where a sorted array changes."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def runs_of(links: list[np.ndarray]) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """(radix, frames, records) of a block from the links of its documents.

    A frame holds pairs and their counts; the records that belong to it hold the number of documents of each pair, and the documents
    with the pair's number of links in each.
    """
    place = np.repeat(np.arange(len(links), dtype=np.uint64), [len(x) for x in links])
    pair = np.concatenate(links).astype(np.uint64)
    # by radix of B, B, A, then document
    key = np.sort((pair >> np.uint64(16) & np.uint64(RADIX - 1)) << np.uint64(58) | pair << np.uint64(26) | place)
    first = steps_of(key)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    place = (key & np.uint64((1 << 26) - 1)).astype(np.int64)
    head = steps_of(key >> np.uint64(26))
    pair = (key[head] >> np.uint64(26) & np.uint64((1 << 32) - 1)).astype(np.int64)
    radix = (key[head] >> np.uint64(58)).astype(np.int64)
    holders = np.diff(np.append(head, len(key)))
    counts = np.add.reduceat(times, head) if len(head) else times
    edges = np.append(head, len(key))
    starts = steps_of(radix).tolist()
    for s, e in zip(starts, [*starts[1:], len(radix)], strict=False):  # none of either, without links
        records = []
        for at in range(s, e, FRAME):
            end = min(at + FRAME, e)
            held = slice(edges[at], edges[end])
            records.append(packed(holders[at:end], place[held], times[held]))
        yield int(radix[s]), framed(pair[s:e], counts[s:e]), records


def spill(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """Documents and runs, told apart by what is null; settled, as blocks are what a task read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, coder, number = TaskContext.get().partitionId(), aligner(path_a, path_b), 0
        held, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                for doc, found in zip(part.column(0).to_pylist(), coder.align(part.column(1).to_pylist()), strict=True):
                    held.append((doc, found))
                    size += 0 if found is None else len(found[2])
                    if len(held) == DOCS or size >= LINKS:
                        yield block_of((task << 32) + number, held)
                        held, size, number = [], 0, number + 1
        if held:
            yield block_of((task << 32) + number, held)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return settle(map_batches(rows, run, ROWS), "alignment-runs")


def block_of(block: int, held: list[tuple]) -> pa.RecordBatch:
    none = np.zeros(0, dtype=np.uint32)
    links = [none if found is None else found[2] for _, found in held]
    runs = list(runs_of(links))
    docs, extra = len(held), len(runs)
    values = [(0, 0, 0, "") if f is None else (f[0], f[1], len(f[2]), hashlib.sha256(f[3].encode()).hexdigest()) for _, f in held]
    columns = [
        [block] * (docs + extra),
        [*range(docs), *[None] * extra],
        [doc for doc, _ in held] + [None] * extra,
        *[[v[k] for v in values] + [None] * extra for k in range(4)],
        *[[None] * docs + [r[k] for r in runs] for k in range(3)],
    ]
    longs, blobs = pa.int64(), pa.list_(pa.binary())
    kinds = [longs, pa.int32(), longs, longs, longs, longs, pa.string(), pa.int32(), blobs, blobs]
    names = [field.split(" ")[0] for field in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def merged(runs: list[Iterator[list[np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) in order from runs of such, each pair once. A frame of each run is held at a time.

    The heap names the run whose frame ends first; what all frames hold up to there is complete.
    """
    heap, frames = [], {}

    def load(k: int) -> None:
        frame = next(runs[k], None)
        if frame is None:
            frames.pop(k, None)
        else:
            frames[k] = frame
            heapq.heappush(heap, (int(frame[0][-1]), k))

    for k in range(len(runs)):
        load(k)
    while heap:
        limit = heap[0][0]
        parts = []
        for k, (pairs, counts) in frames.items():
            at = int(np.searchsorted(pairs, limit, side="right"))
            if at:
                parts.append((pairs[:at], counts[:at]))
                frames[k] = [pairs[at:], counts[at:]]
        while heap and heap[0][0] == limit:
            load(heapq.heappop(heap)[1])
        pairs, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = steps_of(pairs)
        yield pairs[first], np.add.reduceat(counts, first)


def with_best(stream: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Adds whether a pair has the highest count of its B id. The last B id so far is held back: more of it may come."""
    none = np.zeros(0, dtype=np.int64)
    pairs, counts = none, none
    for more, of_more in stream:
        pairs, counts = np.concatenate([pairs, more]), np.concatenate([counts, of_more])
        cut = int(np.searchsorted(pairs, pairs[-1] >> 16 << 16))
        if cut:
            yield pairs[:cut], counts[:cut], best_of(pairs[:cut], counts[:cut])
            pairs, counts = pairs[cut:], counts[cut:]
    if len(pairs):
        yield pairs, counts, best_of(pairs, counts)


def best_of(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first = steps_of(pairs >> 16)
    most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs))))
    return (counts == most).astype(np.int64)


def frames_in(blobs: list[bytes]) -> Iterator[list[np.ndarray]]:
    return (unpacked(b) for b in blobs)


def merge_level(runs: DataFrame, groups: int) -> DataFrame:
    """Runs (radix, block, frames), merged to `groups` of each radix; a last merge, to one, also marks the best pairs."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        give_back()
        stream = merged([frames_in(f) for f in rows.column("frames").to_pylist()])
        if groups == 1:
            stream = with_best(stream)
        # frames of even size, whatever the merge gives at a time
        frames, held, size = [], [], 0
        for part in stream:
            held.append(part)
            size += len(part[0])
            if size >= FRAME:
                frames += framed(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, size = [], 0
        if held:
            frames += framed(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "frames": pa.array([frames], pa.list_(pa.binary()))})

    group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("long").alias("group")
    return runs.select("radix", "block", "frames", group).groupBy("radix", "group").applyInArrow(run, RUN)


def counted(runs: DataFrame, count: int) -> DataFrame:
    """(radix, frames) with all pairs of each radix, their counts, and whether they are best."""
    while count > FAN:
        count = -(-count // FAN)
        runs = settle(merge_level(runs, count), "alignment-merged")
    return settle(merge_level(runs, 1).select("radix", "frames"), "alignment-counts")


def sums_of(runs: DataFrame, counts: DataFrame, count: int) -> DataFrame:
    """(block, best, counts): for the documents of a block, what the pairs of one radix add."""
    groups = -(-count // TOGETHER)

    def run(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        give_back()
        if not rows.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "best": pa.array([], pa.binary()), "counts": pa.array([], pa.binary())})
        pairs, total, best = (np.concatenate(c) for c in zip(*frames_in(known.column("frames")[0].as_py()), strict=True))
        out = []
        for k in range(rows.num_rows):
            block, frames, records = (rows.column(c)[k].as_py() for c in ("block", "frames", "records"))
            parts = []
            for frame, record in zip(frames_in(frames), frames_in(records), strict=True):
                at = np.repeat(np.searchsorted(pairs, frame[0]), record[0])
                parts.append((record[1], record[2] * best[at], record[2] * total[at]))
            place, of_best, of_count = (np.concatenate(c) for c in zip(*parts, strict=True))
            sums = np.zeros((2, int(place.max()) + 1), dtype=np.int64)
            np.add.at(sums[0], place, of_best)
            np.add.at(sums[1], place, of_count)
            out.append((block, packed(sums[0]), packed(sums[1])))
        block, best, counts = zip(*out, strict=True)
        return pa.table({"block": pa.array(block, pa.int64()), "best": pa.array(best, pa.binary()), "counts": pa.array(counts, pa.binary())})

    rows = runs.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    known = counts.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return rows.groupBy("radix", "group").cogroup(known.groupBy("radix", "group")).applyInArrow(run, SUMS)


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    importable(docs.sparkSession)
    stored = spill(docs, id_col, text_col, path_a or vocabulary(VOCABULARY_A), path_b or vocabulary(VOCABULARY_B))
    runs = stored.where("radix is not null").select("radix", "block", "frames", "records")
    count = max(1, runs.select("block").distinct().count())
    sums = sums_of(runs, counted(runs.drop("records"), count), count)

    def run(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        place = rows.column("place").to_numpy()
        sums = np.zeros((2, int(place.max(initial=-1)) + 1), dtype=np.int64)
        for k, name in enumerate(("best", "counts")):
            for raw in found.column(name).to_pylist():
                (more,) = unpacked(raw)
                sums[k, : len(more)] += more
        names = [field.split(" ")[0] for field in RESULT.split(", ")]
        held = {"n_links": rows.column("n_groups"), "n_best": pa.array(sums[0][place]), "count_sum": pa.array(sums[1][place])}
        return pa.table({n: held[n] if n in held else rows.column(n) for n in names})

    texts = stored.where("place is not null").select("block", "place", "id", "n_a", "n_b", "n_groups", "groups_sha256")
    return texts.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(run, RESULT).withColumnRenamed("id", id_col)
