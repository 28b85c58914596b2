"""What a job needs to go on where it, or another before it, left off.

Offsets that have been read are kept as intervals: a partition without holes is one row, however
long it runs, so a message is known again after any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import has_text
from trackloom.operators.offsets import BATCH
from trackloom.operators.slices import slice_start

# Verdicts on a failed batch.
SKIP, RETRY, REJECT = "skip", "retry", "reject"
# Fixed value: a batch is not read again if all its errors name the routing engine.
ENGINE = "OSRM"


def offset_intervals(messages: DataFrame, width: int | None = None) -> DataFrame:
    """(partition, first, last): runs of offsets without a hole. Found within blocks of offsets, then joined up."""
    once = messages.select("partition", "offset").filter(F.col("offset").isNotNull()).distinct()
    sliced = once.withColumn("_slice", slice_start(once, ["offset"], width))
    place = F.row_number().over(Window.partitionBy("partition", "_slice").orderBy("offset"))
    runs = (
        sliced.withColumn("_run", F.col("offset") - place)
        .groupBy("partition", "_slice", "_run")
        .agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    )
    return merge_intervals(runs.select("partition", "first", "last"))


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals that overlap or touch, as one."""
    along = Window.partitionBy("partition").orderBy("first", "last")
    reached = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= reached + 1, 0).otherwise(1)
    return (
        intervals.withColumn("_opens", opens)
        .withColumn("_run", F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("partition", "_run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("_run")
    )


def unseen_messages(messages: DataFrame, intervals: DataFrame, width: int | None = None) -> DataFrame:
    """One row of each (partition, offset) that lies in no interval.

    An offset is known if an interval that starts at or before it reaches it. Messages and starts are put in order
    within blocks of offsets; a row per block carries how far the intervals of earlier blocks reach. So a message meets
    one value, however many intervals there are. The messages are read twice: for the blocks, only their offsets.
    """
    sound = intervals.filter(F.col("partition").isNotNull() & (F.col("first") <= F.col("last")))
    starts = sound.groupBy(F.col("partition").alias("_unit"), F.col("first").alias("_at")).agg(F.max("last").alias("_reach"))

    def in_blocks(rows: DataFrame) -> DataFrame:
        marked = rows.withColumns({"_unit": F.col("partition"), "_at": F.col("offset").cast("bigint"), "_message": F.lit(True)})
        both = marked.unionByName(starts, allowMissingColumns=True)
        return both.withColumn("_slice", slice_start(both, ["_at"], width))

    inside = Window.partitionBy("_unit", "_slice").orderBy("_at")
    along = Window.partitionBy("_unit").orderBy("_slice")
    before = (
        in_blocks(messages.select("partition", "offset"))
        .groupBy("_unit", "_slice")
        .agg(F.max("_reach").alias("_reach"))
        .select("_unit", "_slice", F.max("_reach").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    )
    here = F.max("_reach").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        in_blocks(messages.dropDuplicates(["partition", "offset"]))
        .withColumn("_here", here)
        .filter("_message")
        .join(before, ["_unit", "_slice"], "left")
        .filter(~F.coalesce(F.greatest("_here", "_before") >= F.col("_at"), F.lit(False)))
        .select("partition", *[f"`{name}`" for name in messages.columns if name != "partition"])
    )


def retry_verdicts(
    failed: DataFrame,
    max_attempts: int | None,
    text: str = ENGINE,
    unit: Sequence[str] = BATCH,
    attempts: str = "attempts",
) -> DataFrame:
    """Add ``verdict`` to the rows of failed batches: skip, retry or reject.

    ``skip``: every error of the batch contains the text, so reading it again would not help.
    ``reject``: it has been tried ``max_attempts`` times with this one; ``attempts`` counts the earlier ones.
    Without ``max_attempts`` a batch is tried for ever. A batch has a bounded number of messages,
    so the window over it is bounded too.
    """
    batch = Window.partitionBy(*unit)
    all_match = F.bool_and(F.when(F.col("error").isNotNull(), has_text(F.col("error"), text))).over(batch)
    tried = F.max(attempts).over(batch) + 1
    worn = F.lit(False) if max_attempts is None else tried >= max_attempts
    return failed.withColumn(
        "verdict", F.when(F.coalesce(all_match, F.lit(False)), SKIP).when(worn, REJECT).otherwise(RETRY)
    )
