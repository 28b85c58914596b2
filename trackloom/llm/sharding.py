"""Histogram sort into shards of near-equal bytes.

Rows are ordered by a hash of the text, then by id: equal texts lie together. For the boundary between two shards the
driver keeps an interval of keys. Each round counts the exact bytes of 256 candidate intervals inside it, over all
partitions, and moves into the one that holds the wanted mass, until an edge is within the tolerance. Equal texts share
a hash, so a boundary parts them only where no edge between different texts is near enough; then the
id refines it. When all splitters stand, the rows are exchanged once.

Slots count the rows of a shard from 0: a shard's rows are dealt to chunks by a hash, each chunk is numbered by itself,
and the counts of the chunks before are added. No task holds more than a chunk per shard at a time.

Cases: a null text has no bytes and size 1. Empty tables give no rows. Rows that repeat get slots of their own. A null
id sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackloom.llm.common import settle

SHARDS = 8
#: A boundary may miss the ideal place by this share of a shard.
TOLERANCE = 0.001
#: Rows per chunk, on average over all shards.
CHUNK = 8192
DIGIT = 8
TOP = 1 << 63


@dataclass
class Boundary:
    """Search state: rows below `low` have `below` bytes; digits of the two key parts fixed so far."""

    wanted: float
    prefix: int = 0
    digits: int = 0
    below: int = 0
    splitter: int | None = None


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, size, text_crc32, k0, k1): size in bytes, and the two parts of the key, each in unsigned order; and more columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k0"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-TOP)).bitwiseXOR(F.lit(-TOP)).alias("k1"),
        *more,
    )


def leading(digits: int) -> Column:
    """The first digits of the 128-bit key as text-free columns: whole parts and a shifted one."""
    part, inside = divmod(digits * DIGIT, 64)
    fixed = [F.col(f"k{p}") for p in range(part)]
    if inside:
        fixed.append(F.shiftrightunsigned(f"k{part}", 64 - inside))
    return F.struct(*fixed) if fixed else F.struct(F.lit(0))


def signed(x: int) -> int:
    return x - (1 << 64) if x >= TOP else x


def literal(prefix: int, digits: int) -> Column:
    part, inside = divmod(digits * DIGIT, 64)
    bits = digits * DIGIT
    fixed = [F.lit(signed(prefix >> (bits - 64 * (p + 1)) & (1 << 64) - 1)) for p in range(part)]
    if inside:
        fixed.append(F.lit(prefix & (1 << inside) - 1).cast("long"))
    return F.struct(*fixed) if fixed else F.struct(F.lit(0))


def refine(rows: DataFrame, open_ones: list[Boundary], tolerance: float) -> None:
    """One round for boundaries that have fixed equally many digits."""
    digits = open_ones[0].digits
    part, inside = divmod(digits * DIGIT, 64)
    prefixes = sorted({b.prefix for b in open_ones})
    lead = leading(digits)
    which = F.coalesce(*[F.when(lead == literal(p, digits), F.lit(k)) for k, p in enumerate(prefixes)])
    digit = F.shiftrightunsigned(f"k{part}", 64 - DIGIT - inside).bitwiseAND(F.lit(255))
    counted = rows.groupBy(which.alias("which"), digit.alias("digit")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    mass = {(r["which"], r["digit"]): (r["bytes"], r["n"]) for r in counted.where("which is not null").collect()}
    for b in open_ones:
        k, at = prefixes.index(b.prefix), b.below
        for d in range(256):
            size, n = mass.get((k, d), (0, 0))
            if at + size >= b.wanted or d == 255:
                break
            at += size
        miss_low, miss_high = b.wanted - at, at + size - b.wanted
        b.prefix, b.digits, b.below = b.prefix << DIGIT | d, digits + 1, at
        last = n <= 1 or b.digits * DIGIT == 128
        if min(miss_low, miss_high) <= tolerance or last:
            b.splitter = b.prefix + (miss_high < miss_low) << 128 - b.digits * DIGIT


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[int]:
    """The 128-bit keys at which the shards after the first begin. The driver sees 256 sums per boundary and round."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    bounds = [Boundary(total * k / shards) for k in range(1, shards)]
    if not total:
        return [1 << 128] * (shards - 1)
    while waiting := [b for b in bounds if b.splitter is None]:
        refine(rows, waiting, tolerance * total / shards)
    return [b.splitter for b in bounds]


def at_or_above(splitter: int) -> Column:
    """Whether a row's key is at least the splitter, by signed comparison of the flipped parts."""
    if splitter >= 1 << 128:
        return F.lit(False)
    high, low = signed(splitter >> 64 ^ TOP), signed(splitter & (1 << 64) - 1 ^ TOP)
    k0, k1 = F.col("k0").bitwiseXOR(F.lit(-TOP)), F.col("k1").bitwiseXOR(F.lit(-TOP))
    return (k0 > F.lit(high)) | ((k0 == F.lit(high)) & (k1 >= F.lit(low)))


def shard_by_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row. Texts are read once; the rounds read numbers only, and only numbers are exchanged."""
    rows = settle(keyed(docs, id_col, text_col), "shard-keys")
    placed = with_places(rows, splitters(rows, shards, tolerance), 1 + rows.count() // CHUNK)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def shard_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Every row of docs as `row`, a struct of its columns, where it belongs: with `shard` and `slot`.

    The splitters come from numbers; then the rows cross one exchange, with all their columns.
    """
    keys = settle(keyed(docs, id_col, text_col), "shard-keys")
    marks, chunks = splitters(keys, shards, tolerance), 1 + keys.count() // CHUNK
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return with_places(keyed(docs, id_col, text_col, row), marks, chunks).select("row", "shard", "slot")


def with_places(rows: DataFrame, marks: list[int], chunks: int) -> DataFrame:
    shard = sum((at_or_above(m).cast("int") for m in marks), F.lit(0))
    placed = rows.withColumn("shard", shard).withColumn("chunk", F.pmod(F.xxhash64("k1", "k0"), F.lit(chunks)))
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "chunk").orderBy("k0", "k1")
    numbered = placed.withColumn("n", F.row_number().over(within)).join(bases, ["shard", "chunk"])
    return numbered.withColumn("slot", F.col("base") + F.col("n") - 1)
