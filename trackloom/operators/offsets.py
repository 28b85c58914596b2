"""Message batches and offsets of a partitioned topic, on tables.

On a stream the checkpoint does this work; these are the table forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import batch_key, has_text
from trackloom.operators.slices import with_position

BATCH = ("partition", "batch_id")
# Fixed value: messages of one partition handled together.
BATCH_MESSAGES = 10


def assign_batches(messages: DataFrame, n: int = BATCH_MESSAGES, width: int | None = None) -> DataFrame:
    """Cut each partition, in offset order, into runs of at most n messages (``batch_id`` from 0)."""
    placed = with_position(messages, ["partition"], ["offset"], "_pos", width)
    batch = F.floor((F.col("_pos") - 1) / F.lit(n)).cast("bigint")
    return placed.withColumn("batch_id", batch).drop("_pos")


def start_from(messages: DataFrame, offsets: DataFrame) -> DataFrame:
    """Messages from a given offset of their partition on; all of a partition not listed."""
    starts = offsets.select("partition", F.col("offset").alias("_start"))
    return (
        messages.join(starts, "partition", "left")
        .filter(F.col("offset") >= F.coalesce("_start", F.lit(0)))
        .drop("_start")
    )


def skip_processed(
    messages: DataFrame, offsets: DataFrame, batch: Sequence[str] = BATCH
) -> DataFrame:
    """Leave out batches whose first offset is at or below the last processed one.

    A batch has a bounded number of messages, so the window over it is bounded too.
    A partition without a stored offset is processed from its first message.
    """
    done = offsets.select("partition", F.col("offset").alias("_done"))
    first = F.min("offset").over(Window.partitionBy(*batch))
    return (
        messages.withColumn("_first", first)
        .join(done, "partition", "left")
        .filter(F.col("_first") > F.coalesce("_done", F.lit(-1)))
        .drop("_first", "_done")
    )


def drop_inflight_duplicates(
    messages: DataFrame, keys: Sequence[str] = ("partition", "offset"), watermark: str | None = None
) -> DataFrame:
    """One row per (partition, offset).

    On a stream give a ``watermark`` delay on the source column ``timestamp``, so that
    the state of seen keys is dropped in time.
    """
    if watermark is not None:
        return messages.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(
            list(keys)
        )
    return messages.dropDuplicates(list(keys))


def last_offsets(commits: DataFrame, commit_order: str = "commit_seq") -> DataFrame:
    """Last committed offset of each partition: the last write wins."""
    return commits.groupBy("partition").agg(F.max_by("offset", commit_order).alias("offset"))


def batch_summary(
    messages: DataFrame,
    smoothed: DataFrame | None = None,
    written: DataFrame | None = None,
    batch: Sequence[str] = BATCH,
) -> DataFrame:
    """Messages, first and last offset and errors per batch; with output and written counts.

    All sides are tagged and counted in one aggregate, so each input is read once and only
    counts are exchanged. Batches appear if they have messages.
    """
    keys = list(batch)
    sides = {"outputs": smoothed, "written": written}
    present = [name for name, rows in sides.items() if rows is not None]
    tagged = messages.select(*keys, "offset", "error", F.lit("messages").alias("_side"))
    for name in present:
        none = [F.lit(None).cast(messages.schema[c].dataType).alias(c) for c in ("offset", "error")]
        tagged = tagged.unionByName(sides[name].select(*keys, *none, F.lit(name).alias("_side")))
    summary = tagged.groupBy(*keys).agg(
        F.count_if(F.col("_side") == "messages").alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count("error").alias("errors"),
        *[F.count_if(F.col("_side") == name).alias(name) for name in present],
    )
    summary = summary.filter(F.col("messages") > 0)
    return summary.withColumn("batch_key", batch_key(F.col("partition"), F.col("first_offset")))


def all_errors_match(
    messages: DataFrame, text: str, batch: Sequence[str] = BATCH
) -> DataFrame:
    """For each batch with errors: does every error contain the text?"""
    return (
        messages.filter(F.col("error").isNotNull())
        .groupBy(*batch)
        .agg(F.bool_and(has_text(F.col("error"), text)).alias("all_match"))
    )
