"""Quartile bucket digests: locality-sensitive fingerprints of whole texts.

Byte triplets of a sliding window are hashed into buckets and counted. A digest holds the log length and,
for each bucket, the quartile of its count among all buckets. Two digests are compared by a difference score:
the sum of the quartile steps (a jump from lowest to highest counts double) and of the length steps, over its
greatest possible value. A likeness is 1 minus that.

Cases: a null text is the empty text. Texts too short for a triplet have all buckets in the lowest quartile and
differ by length only. Rows that share an id are ordered by text. One row alone is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import as_bytes, batch, map_batches
from trackloom.llm.ordering import ordered_blocks

#: A power of two.
BUCKETS = 256
#: Offsets of a triplet's bytes within the window, and a salt for each kind of triplet.
TRIPLETS = [((0, 1, 2), 1), ((0, 1, 3), 3), ((0, 2, 3), 5), ((0, 2, 4), 7)]
#: Cost of a bucket whose quartiles lie 0 to 3 steps apart.
STEPS = np.array([0, 1, 2, 6], dtype=np.int64)
LENGTH_STEP, LENGTH_MOST = 12, 25
MOST = BUCKETS * 6 + LENGTH_STEP * LENGTH_MOST


def length_code(n: int) -> int:
    """Length in steps of a quarter of a power of two."""
    return 0 if n == 0 else min(255, 1 + int(4 * np.log2(n)))


def digest(text: bytes) -> tuple[int, np.ndarray]:
    """Length code and the quartile, 0 to 3, of every bucket."""
    x = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for (a, b, c), salt in TRIPLETS:
        n = len(x) - c
        if n <= 0:
            continue
        h = x[a : a + n] * np.uint32(0x9E3779B1) + x[b : b + n] * np.uint32(0x85EBCA77) + x[c : c + n] * np.uint32(0xC2B2AE3D)
        h += np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(h >> np.uint32(33 - BUCKETS.bit_length()), minlength=BUCKETS)
    ranked = np.sort(counts)
    limits = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    return length_code(len(text)), np.searchsorted(limits, counts, side="left").astype(np.uint8)


def encode(code: tuple[int, np.ndarray]) -> str:
    """Hexadecimal: length, then four buckets a byte."""
    q = code[1].reshape(-1, 4)
    return (bytes([code[0]]) + (q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6).tobytes()).hex()


def decode(text: str) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(text), dtype=np.uint8)
    return int(raw[0]), np.stack([raw[1:] >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)


def difference(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> int:
    """0 (equal digests) to MOST."""
    steps = np.abs(a[1].astype(np.int8) - b[1].astype(np.int8))
    return int(STEPS[steps].sum()) + LENGTH_STEP * min(abs(a[0] - b[0]), LENGTH_MOST)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    return 1.0 - difference(a, b) / MOST


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [encode(digest(t)) for t in as_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string())], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "id long, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last half of the text gives way to as much of the following text's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness; see `edited`.

    The following document is the next by ascending id, after the last the first. One exchange deals the texts by
    ranges of the id; a partition holds one document and the next at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, False
        for b in batches:
            out = []
            for doc, text, guest in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                if done:
                    continue
                code = digest(text)
                if held is not None:
                    out.append(pair(*held, text, code))
                done = guest
                held = None if guest else (doc, text, code)
            if out:
                yield batch({name: (list(v), kind) for (name, kind), v in zip(KINDS.items(), zip(*out, strict=True), strict=True)})

    def pair(doc, text: bytes, code, following: bytes, next_code) -> tuple:
        own = text.decode()
        changed = edited(own, following.decode()).encode()
        changed_code = digest(changed)
        sha = hashlib.sha256(changed).hexdigest()
        return doc, len(own), sha, encode(code), encode(changed_code), likeness(code, changed_code), likeness(code, next_code)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = ordered_blocks(rows, "id").sortWithinPartitions("guest", "key", "text").select("id", "text", "guest")
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(dealt, run, schema).withColumnRenamed("id", id_col)


KINDS = {
    "id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}
