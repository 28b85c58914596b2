"""Operators along a track: the fixes of one unit in order.

A unit is a device by default. ``["partition", "batch_id"]`` gives the pairing of
one message batch instead, whatever devices are in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions import haversine_m
from trackloom.operators.slices import with_next, with_position

UNIT = ("device_id",)
ORDER = ("timestamp", "offset")
# Fixed value: consecutive fixes further apart than this leave a gap.
GAP_METRES = 100.0


def consecutive_pairs(
    points: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    carry: Sequence[str] = ("latitude", "longitude", "speed"),
    width: int | None = None,
    bounded: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Each fix with the next one of its unit in ``next``; null on the last.

    With ``max_rows`` no task's window holds more rows of a unit, here and in what follows.
    """
    return with_next(points, unit, order, carry, width, bounded, max_rows).drop("alone")


def unit_bounds(
    points: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    width: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Mark the last fix of a unit (``is_last``) and the only one (``alone``)."""
    marked = with_next(points, unit, order, [order[0]], width, max_rows=max_rows)
    return marked.withColumn("is_last", F.col("next").isNull()).drop("next")


def segment_distance(pairs: DataFrame) -> DataFrame:
    """Distance in metres from each fix to the next, on the original coordinates."""
    return pairs.withColumn(
        "metres",
        haversine_m(
            F.col("latitude"), F.col("longitude"), F.col("next.latitude"), F.col("next.longitude")
        ),
    )


def longer_than(metres: Column, limit: float) -> Column:
    """A distance beyond a limit. An undefined distance (NaN) is not; Spark sorts NaN last."""
    return F.nanvl(metres, F.lit(0.0)) > limit


def gap_summary(
    points: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    width: int | None = None,
    gap_metres: float = GAP_METRES,
    max_rows: int | None = None,
) -> DataFrame:
    """Segments, gaps and path length of each unit that has at least one segment."""
    narrow = points.select(*dict.fromkeys([*unit, *order, "latitude", "longitude"]))
    pairs = consecutive_pairs(narrow, unit, order, ("latitude", "longitude"), width, max_rows=max_rows)
    return (
        segment_distance(pairs)
        .filter(F.col("next").isNotNull())
        .groupBy(*unit)
        .agg(
            F.count(F.lit(1)).alias("segments"),
            F.count_if(longer_than(F.col("metres"), gap_metres)).alias("gaps"),
            F.sum("metres").alias("path_metres"),
        )
    )


def every_nth(
    rows: DataFrame,
    n: int = 10,
    unit: Sequence[str] = ("veh_id",),
    order: Sequence[str] = ("offset",),
    width: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Every n-th row of a unit, with its 1-based position in ``pos``."""
    return with_position(rows, unit, order, "pos", width, max_rows).filter(F.pmod("pos", F.lit(n)) == 0)


def tracks(
    rows: DataFrame,
    unit: Sequence[str] = ("veh_id",),
    order: Sequence[str] = ("offset",),
    width: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Rows as numbered elements of their unit's list: ``pos`` counts from 1.

    A track stays a set of rows. Its list is never built in one place, so its
    length has no bound; the list's element k is the row with ``pos = k``.
    """
    return with_position(rows, unit, order, "pos", width, max_rows)


def track_lists(
    rows: DataFrame,
    value: Sequence[str],
    max_length: int = 10_000,
    unit: Sequence[str] = ("veh_id",),
    order: Sequence[str] = ("offset",),
    width: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Tracks as arrays. A track longer than ``max_length`` continues in the next ``part``."""
    numbered = tracks(rows, unit, order, width, max_rows)
    part = F.floor((F.col("pos") - 1) / F.lit(max_length)).cast("bigint")
    items = F.array_sort(F.collect_list(F.struct("pos", *value)))
    return (
        numbered.withColumn("part", part)
        .groupBy(*unit, "part")
        .agg(items.alias("items"))
    )


def output_order(
    rows: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Fix, its inserted points by ``j``, next fix, ...: a range-partitioned total sort."""
    return rows.orderBy(*unit, *order, "j")
