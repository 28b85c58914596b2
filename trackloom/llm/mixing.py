"""Mixing sources to target weights by systematic sampling.

Every source gets a target of words; each of its documents is then expected to occur target / source size times. The
expectations are summed along the source, one offset between 0 and 1 is added, and a document occurs once for
each whole number that its stretch of the sum crosses. Documents are lined up by size, so that copies are spread evenly over sizes
and the words taken come within a few documents of the target.

A document's place in its source is found without a task that sees the source: documents are counted by size class
and chunk, the counts are summed over classes (a bounded number) and over chunks of a class, and only
the rows of one chunk are numbered together.

Cases: a null text has size 0. A null source is a source of its own, last in order. Sources of size 0 get target 0 and
nothing is taken. Rows that repeat count each. Reruns agree: offset and order come from hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackloom.llm.common import settle

WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all sizes, in halves: 3 halves are 150 %.
HALVES = 3
#: A target stops at this many times its source's size.
MOST = 2
WORD = r"[^\x20\x09-\x0D]+"
#: Rows per chunk, on average.
CHUNK = 65536
SEED = "mix"


def fraction_bits(text: Column) -> Column:
    """A whole number below 2^32 from a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """The size rounded down to its 11 leading bits: exact below 2048, and few classes beyond."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - 11)
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def targets(sizes: DataFrame) -> DataFrame:
    """From (source, source_size), one row per source, adds the target.

    Weights repeat along the sources by code point, null last. A level per unit of weight is found such that the
    capped targets sum to the wanted total: what a capped source leaves goes to the others by weight.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place + 1).cast("long")
    rows = sizes.withColumn("weight", weight)
    cap = F.col("source_size") * MOST
    rising = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum(cap).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * HALVES - before * 2).cast("double") / (weights * 2).cast("double")
    tried = rows.withColumn("level", level)
    fits = F.col("level") * F.col("weight") <= cap.cast("double")
    levels = tried.withColumn("level", F.max(F.when(fits, F.col("level"))).over(everything))
    return levels.select("source", "source_size", F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """(id, size, source_size, target, copies) of every row."""
    return counted_copies(docs, id_col, text_col, source_col, [], seed).withColumnRenamed("id", id_col)


def counted_copies(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str], seed: str) -> DataFrame:
    """As `sample`, with the columns named in `keep` as keep_0, keep_1 and so on.

    Without `keep` the texts are read once and the sizes settled. With it they are read twice, for the counts and for the rows,
    and cross one exchange: the places of a chunk come to where its rows were numbered.
    """
    kept = [F.col(f"`{c}`").alias(f"keep_{k}") for k, c in enumerate(keep)]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *kept,
    ).withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    if not kept:
        rows = settle(rows, "mix-sizes")
    chunks = 1 + rows.count() // CHUNK
    chunk = F.pmod(fraction_bits(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(chunks))
    binned = rows.withColumn("class", size_class(F.col("size"))).withColumn("chunk", chunk)
    counts = settle(binned.groupBy("source", "key", "class", "chunk").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "mix-counts")
    places = settle(chunk_places(counts), "mix-places")

    within = Window.partitionBy("key", "class", "chunk").orderBy("size", "id")
    ready = binned.drop("source").withColumn("n", F.row_number().over(within)).join(places, ["key", "class", "chunk"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    offset = fraction_bits(F.concat(F.lit(seed), F.col("key"))).cast("double") / F.lit(float(1 << 32))
    ready = ready.withColumn("place", F.col("before") + F.col("n")).withColumn("expected", expected).withColumn("offset", offset)
    crossed = F.floor(F.col("offset") + F.col("expected") * F.col("place")) - F.floor(F.col("offset") + F.col("expected") * (F.col("place") - 1))
    copies = F.least(crossed, F.lit(MOST)).cast("long")
    return ready.select("id", "size", "source_size", "target", copies.alias("copies"), *[f"keep_{k}" for k in range(len(kept))])


def chunk_places(counts: DataFrame) -> DataFrame:
    """(key, class, chunk, before, source_size, target): how many rows of its source stand before each chunk of a class."""
    sums = counts.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = targets(sums).withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    earlier = [Window.unboundedPreceding, -1]
    in_class = Window.partitionBy("key", "class").orderBy("chunk").rowsBetween(*earlier)
    by_chunk = counts.select("key", "class", "chunk", F.coalesce(F.sum("n").over(in_class), F.lit(0)).alias("of_class"))
    by_class = counts.groupBy("key", "class").agg(F.sum("n").alias("n"))
    in_source = Window.partitionBy("key").orderBy("class").rowsBetween(*earlier)
    by_class = by_class.select("key", "class", F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("of_source")).join(known, "key")
    before = (F.col("of_class") + F.col("of_source")).alias("before")
    return by_chunk.join(by_class, ["key", "class"]).select("key", "class", "chunk", before, "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row of docs as often as it is taken, with the columns of docs."""
    names = list(docs.columns)
    taken = counted_copies(docs, id_col, text_col, source_col, names, seed)
    repeated = taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"keep_{k}").alias(c) for k, c in enumerate(names)])
