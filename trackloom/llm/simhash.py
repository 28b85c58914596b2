"""Near duplicates by SimHash fingerprints, joined by Golay-code fuzzy hashing.

A bit of a fingerprint is 1 if it is set in over half of the hashes of a text's word shingles. Fingerprints of 64 bits are linked when they
differ in at most two. Each is cut in three segments; a key is the exact bits of one segment and the index of a Golay
codeword near the next one, in a circle. However two errors fall on three segments, one segment has none and the next has at most one: and words
that differ in one bit share a codeword within four bits. So a linked pair shares a key. A fingerprint has 3 to 18 keys of
some 33 bits, 16 on average.

* Equal texts have one fingerprint and collapse before anything is joined.
* Keys of up to `limit` fingerprints: their pairs are compared, and only true links leave the key.
* Fuller keys, exactly: their fingerprints are sent to the 65 words within one bit of them. Linked ones meet at such a word, what meets
  there is linked, and no word is met by more than 65. So no group grows with the data.
* The fullest keys, by share of all, are few whatever the input; they are sent to all tasks, and their rows cross no exchange by key.

Cases: a null text, or one without words, has fingerprint zero and is linked like any other; a text of fewer words than a shingle is one
shingle. Rows that share an id or a text count each. A null id names no component: the id of one that has no other is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import as_bytes, batch, map_batches, settle
from trackloom.llm.components import components
from trackloom.llm.golay import nearby

WIDTH = 3
SEED = 42
#: Bits that linked fingerprints differ in, at most: what three segments in a circle can catch.
DISTANCE = 2
#: Fingerprints of a key that are compared pair by pair, at most.
LIMIT = 16
#: A key with more than this part of all rows is one of the fullest; so there are fewer than this many.
FULLEST = 4096
#: Shingles that are counted together.
PART = 1 << 16
LOWER = bytes.maketrans(bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("a"), ord("z") + 1)))
#: (shift, bits) of the segments.
SEGMENTS = ((43, 21), (22, 21), (0, 22))


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint as a signed number of 64 bits."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    count, ones = max(1, len(words) - width + 1), np.zeros(64, dtype=np.int64)
    hashed, joined = xxhash.xxh64_digest, b" ".join
    for at in range(0, count, PART):
        found = b"".join([hashed(joined(words[k : k + width]), SEED) for k in range(at, min(at + PART, count))])
        ones += np.unpackbits(np.frombuffer(found, dtype=np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, print) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t, width) for t in as_bytes(b.column(1))]
            yield batch({"id": (b.column(0).to_pylist(), pa.int64()), "print": (found, pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "id long, print long")


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which fingerprint, key) for all keys: number of the exact segment, its bits, a codeword near the next one."""
    whole = prints.view(np.uint64)
    segments = [(whole >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64) for shift, bits in SEGMENTS]
    which, keys = [], []
    for k, exact in enumerate(segments):
        place, index = nearby(segments[(k + 1) % len(segments)])
        which.append(place)
        keys.append((k << 34) + (exact[place] << 12) + index)
    return np.concatenate(which), np.concatenate(keys)


def with_keys(prints: DataFrame) -> DataFrame:
    """(print, key) of every distinct fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column(0).to_numpy()
            which, keys = keys_of(held)
            yield pa.RecordBatch.from_arrays([pa.array(held[which]), pa.array(keys)], names=["print", "key"])

    return map_batches(prints.select("print"), run, "print long, key long")


def links_of(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect whatever differs in at most two bits; each is such a link."""
    keys = settle(with_keys(prints), "simhash-keys")
    shared = settle(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-shared")
    full = max(limit, keys.count() // FULLEST)
    fullest = F.broadcast(shared.where(F.col("n") > full).select("key"))
    rest = keys.join(fullest, "key", "left_anti")

    small = rest.join(shared.where(F.col("n") <= limit).select("key"), "key").groupBy("key").agg(F.sort_array(F.collect_list("print")).alias("prints"))
    pairs = f"flatten(transform(prints, (x, i) -> transform(slice(prints, i + 2, {limit}), y -> named_struct('a', x, 'b', y))))"
    close = small.select(F.inline(F.expr(f"filter({pairs}, p -> bit_count(p.a ^ p.b) <= {DISTANCE})")))

    larger = rest.join(shared.where((F.col("n") > limit) & (F.col("n") <= full)).select("key"), "key", "left_semi")
    crowded = keys.join(fullest, "key", "left_semi").unionByName(larger).select("print").distinct()
    words = "concat(array(print), transform(sequence(0, 63), i -> print ^ shiftleft(1L, i)))"
    met = crowded.select("print", F.explode(F.expr(words)).alias("word")).groupBy("word").agg(F.sort_array(F.collect_list("print")).alias("prints"))
    at_words = met.where(F.size("prints") > 1).select(F.expr("prints[0]").alias("a"), F.explode(F.expr("slice(prints, 2, 64)")).alias("b"))
    return close.unionByName(at_words)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, limit: int = LIMIT) -> DataFrame:
    """(id, fingerprint, component_id) of every row: 16 hex digits, and the smallest id that links reach from it."""
    rows = settle(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    prints = settle(rows.groupBy("print").agg(F.min("id").alias("first")), "simhash-distinct")
    labels = settle(components(links_of(prints, limit)), "simhash-labels")
    joined = prints.join(labels, F.col("print") == F.col("node")).select("print", "label", "first")
    least = joined.groupBy(F.col("label").alias("of")).agg(F.min("first").alias("least"))
    reached = joined.join(least, F.col("label") == F.col("of")).select(F.col("print").alias("at"), "least")
    known = prints.join(reached, F.col("print") == F.col("at"), "left")
    known = settle(known.select(F.col("print").alias("at"), F.when(F.col("at").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id")), "simhash-components")
    # one row a fingerprint on the right: a fingerprint that very many rows share is split by the skew join
    out = rows.join(known, F.col("print") == F.col("at"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
