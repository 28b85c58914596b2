"""Order-preserving slices, so that one busy unit never has to fit in one task.

``lead`` and ``row_number`` over a whole unit put every row of that unit into one
task. Here a unit is first cut into slices along its order column (a span of time,
or a block of offsets). The window runs inside ``(unit, slice)``, which spreads a
busy unit over the cluster, and one small row per slice carries what crosses a
slice edge. The results equal those of the window over the whole unit.

Units whose size has a bound, such as message batches, are ``bounded``: for them the
plain window is right and saves the second pass. A span of time bounds seconds; ``max_rows``
bounds the rows of a slice, whatever falls into a span (``operators/row_slices.py``).

Unit columns must not be null (missing text is ``''`` in the data model).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# About 180 fixes of a device that reports every five seconds.
SLICE_SECONDS = 900
# Offsets are unique in a partition, so a slice holds at most this many rows.
SLICE_OFFSETS = 100_000


def slice_start(df: DataFrame, order: Sequence[str], width: int | None) -> Column:
    """Start of the slice a row falls in, from the first order column.

    ``width`` counts seconds for a timestamp and units for a whole number. Equal
    order values always share a slice and slices follow the order, whatever the
    further order columns are.
    """
    first = F.col(order[0])
    kind = df.schema[order[0]].dataType
    if isinstance(kind, T.TimestampType):
        micros = F.unix_micros(first)
        span = F.lit((width or SLICE_SECONDS) * 1_000_000)
        return micros - F.pmod(micros, span)
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        value = first.cast("bigint")
        return value - F.pmod(value, F.lit(width or SLICE_OFFSETS))
    raise TypeError(f"slices need a timestamp or a whole number, not {kind.simpleString()}")


def _sliced(df: DataFrame, unit: list[str], order: list[str], width: int | None, max_rows: int | None) -> DataFrame:
    if max_rows is None:
        return df.withColumn("_slice", slice_start(df, order, width))
    from trackloom.operators.row_slices import with_row_slices

    return with_row_slices(df, unit, order, max_rows, width)


def with_next(
    df: DataFrame,
    unit: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    width: int | None = None,
    bounded: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``next`` (struct of the next row's ``carry`` columns) and ``alone``.

    ``next`` is null on the last row of a unit; ``alone`` marks the only row of one.
    """
    unit, order = list(unit), list(order)
    payload = F.struct(*carry)
    if bounded:
        whole = Window.partitionBy(*unit).orderBy(*order)
        return df.select(
            "*",
            F.lead(payload).over(whole).alias("next"),
            (F.count(F.lit(1)).over(Window.partitionBy(*unit)) == 1).alias("alone"),
        )

    sliced = _sliced(df, unit, order, width, max_rows)
    inside = Window.partitionBy(*unit, "_slice").orderBy(*order)
    along = Window.partitionBy(*unit).orderBy("_slice")

    edges = (
        sliced.groupBy(*unit, "_slice")
        .agg(F.min_by(payload, F.struct(*order)).alias("_head"))
        .select(
            *unit,
            "_slice",
            F.lead("_head").over(along).alias("_after"),
            F.lag("_slice").over(along).isNull().alias("_opens"),
        )
    )
    return (
        sliced.withColumn("_inside", F.lead(payload).over(inside))
        .withColumn("_place", F.row_number().over(inside))
        .join(edges, [*unit, "_slice"], "left")
        .withColumn("next", F.coalesce("_inside", "_after"))
        .withColumn("alone", F.col("next").isNull() & F.col("_opens") & (F.col("_place") == 1))
        .select(*df.columns, "next", "alone")
    )


def with_position(
    df: DataFrame,
    unit: Sequence[str],
    order: Sequence[str],
    name: str = "pos",
    width: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its unit."""
    unit, order = list(unit), list(order)
    sliced = _sliced(df, unit, order, width, max_rows)
    inside = Window.partitionBy(*unit, "_slice").orderBy(*order)
    before = (
        Window.partitionBy(*unit)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    starts = (
        sliced.groupBy(*unit, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*unit, "_slice", (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"))
    )
    return (
        sliced.withColumn("_place", F.row_number().over(inside))
        .join(starts, [*unit, "_slice"], "left")
        .withColumn(name, F.col("_before") + F.col("_place"))
        .select(*df.columns, name)
    )
