"""Questions from blocks of documents to buckets of keys, and the answers back.

A block is a part of the documents that one task holds. It asks about many short keys; millions of rows would carry
more headers than content, so the keys of one block for one bucket travel as one row of packed arrays. The bucket
answers with one byte per key, in the same order, and the block finds it again by asking the same question.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import give_back, importable
from trackloom.llm.ordering import id_key

#: Documents per block on average, at most.
DOCS_IN_BLOCK = 2048

QUESTION = "bucket int, block int, hi binary, lo binary, owner binary"
ANSWER = "block int, level int, bucket int, codes binary"


def blocks_of(docs: DataFrame, id_col: str, text_col: str, carry: str | None = None) -> tuple[DataFrame, int]:
    """(key, id, text, block) of the documents and the number of blocks. Grouped by block, all passes share one exchange.

    `carry` names a whole number that takes the place of `id`; the key, and so the order, stays that of the id.
    """
    importable(docs.sparkSession)
    count = 1 + docs.count() // DOCS_IN_BLOCK
    rows = docs.select(id_key(id_col).alias("key"), F.col(carry or id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # rows that share an id are spread too
    return rows.withColumn("block", F.pmod(F.xxhash64("key", F.crc32(F.col("text").cast("binary"))), F.lit(count)).cast("int")), count


def bucket_bits(blocks: int) -> int:
    return min(24, max(1, (blocks - 1).bit_length()))


class Keys:
    """Distinct pairs (hi, lo) of 64-bit numbers with the least owner of each, in the order of their buckets."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, owner: np.ndarray):
        """Takes occurrences in rising order of owner."""
        mixed = hi & np.uint64(0xFFFFFFFF00000000) | lo >> np.uint64(32)
        order = np.argsort(mixed, kind="stable")
        hi, lo = hi[order], lo[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        first = np.flatnonzero(new)
        #: For each occurrence the number of its key.
        self.of = np.empty(len(order), dtype=np.int64)
        self.of[order] = np.cumsum(new) - 1
        #: For each key its first occurrence, which has the least owner.
        self.first = order[first]
        self.hi, self.lo, self.owner = hi[first], lo[first], owner[self.first]

    def slices(self, bits: int) -> Iterator[tuple[int, slice]]:
        """Buckets by the leading bits of hi."""
        edges = np.searchsorted(self.hi >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            yield bucket, slice(edges[bucket], edges[bucket + 1])

    def questions(self, block: int, bits: int) -> pa.Table:
        rows = [(b, block, six(self.hi[s]), six(self.lo[s]), owners(self.owner[s])) for b, s in self.slices(bits)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(["bucket", "block", "hi", "lo", "owner"], columns, kinds, strict=True)})

    def answers(self, replies: pa.Table, level: int, bits: int) -> np.ndarray:
        """One code per key, from the answers to this block's questions of a level."""
        by_bucket = {b: c for b, lv, c in zip(*(replies.column(n).to_pylist() for n in ("bucket", "level", "codes")), strict=True) if lv == level}
        codes = np.zeros(len(self.hi), dtype=np.uint8)
        for bucket, s in self.slices(bits):
            codes[s] = np.frombuffer(by_bucket[bucket], dtype=np.uint8)
        return codes


def planes(x: np.ndarray, low: int, high: int) -> bytes:
    """Bytes low to high of each number, all first ones, then all second ones: sorted numbers compress that way."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, low:high].T).tobytes()


def from_planes(raw: bytes, low: int, high: int) -> np.ndarray:
    out = np.zeros((len(raw) // (high - low), 8), dtype=np.uint8)
    out[:, low:high] = np.frombuffer(raw, dtype=np.uint8).reshape(high - low, -1).T
    return out.view("<u8").reshape(-1)


def six(x: np.ndarray) -> bytes:
    """The six leading bytes of each number."""
    return planes(x, 2, 8)


def from_six(raw: bytes) -> np.ndarray:
    return from_planes(raw, 2, 8)


def owners(x: np.ndarray) -> bytes:
    """Ids as the least one and what the others lie above it, in as few bytes as they allow."""
    least = int(x.min())
    above = x.astype(np.uint64) - np.uint64(least % (1 << 64))
    width = max(1, (int(above.max()).bit_length() + 7) // 8)
    return least.to_bytes(8, "little", signed=True) + bytes([width]) + planes(above, 0, width)


def from_owners(raw: bytes) -> np.ndarray:
    least, width = int.from_bytes(raw[:8], "little", signed=True), raw[8]
    return (from_planes(raw[9:], 0, width) + np.uint64(least % (1 << 64))).astype(np.int64)


def ask(blocks: DataFrame, run: Callable, replies: DataFrame | None = None, schema: str = QUESTION) -> DataFrame:
    """Runs once per block: run(block number, documents, answers so far)."""
    grouped = blocks.groupBy("block")

    def alone(key: tuple, docs: pa.Table) -> pa.Table:
        return with_answers(key, docs, None)

    def with_answers(key: tuple, docs: pa.Table, got: pa.Table | None) -> pa.Table:
        give_back()
        return run(key[0].as_py(), docs, got)

    if replies is None:
        return grouped.applyInArrow(alone, schema)
    return grouped.cogroup(replies.groupBy("block")).applyInArrow(with_answers, schema)


def answer(questions: DataFrame, level: int, judge: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Answers bucket by bucket: judge(hi, lo, owner) gives a code per key; keys come sorted by hi, lo, owner."""

    def run(key: tuple, asked: pa.Table) -> pa.Table:
        give_back()
        raw = [asked.column(n).to_pylist() for n in ("block", "hi", "lo", "owner")]
        hi, lo = (np.concatenate([from_six(x) for x in raw[k]]) for k in (1, 2))
        owner = np.concatenate([from_owners(x) for x in raw[3]])
        order = np.lexsort((owner, lo, hi))
        codes = np.empty(len(order), dtype=np.uint8)
        codes[order] = judge(hi[order], lo[order], owner[order])
        ends = np.cumsum([len(x) // 6 for x in raw[1]])
        parts = [codes[e - len(x) // 6 : e].tobytes() for e, x in zip(ends, raw[1], strict=True)]
        n = len(parts)
        return pa.table(
            {"block": pa.array(raw[0], pa.int32()), "level": pa.array([level] * n, pa.int32()), "bucket": pa.array([key[0].as_py()] * n, pa.int32()), "codes": pa.array(parts, pa.binary())}
        )

    return questions.groupBy("bucket").applyInArrow(run, ANSWER)


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted sequence of tuples changes."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new
