"""Slices of a unit with a bounded number of rows.

A span of time holds any number of rows: a device that repeats itself a million times within a
second has them all in one slice. Here spans are counted exactly, and one with too many rows is
cut into parts of its own range, again and again, by the first order column that still tells its
rows apart: ties in one column are cut by the next. Only spans that are too full are looked at
again, and the rows learn their slice from joins with these few.

A slice is named by its path, an array of lower bounds. Paths of a unit compare as its rows do.
Planning runs one counting job, and two more for each level of cutting; most data need none.
Rows that are equal in every order column stay together, since nothing orders them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.operators.slices import SLICE_OFFSETS, SLICE_SECONDS

# Parts that a slice is cut into at once, at most.
MOST_PARTS = 1024
# Stands for a missing value, which sorts first.
LOWEST = -(2**62)


def order_number(df: DataFrame, name: str) -> Column:
    """A whole number that sorts like the column."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, T.DateType):
        column = F.unix_date(column)
    elif isinstance(kind, T.BooleanType):
        column = column.cast("int")
    elif not isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"slices need times or whole numbers, not {kind.simpleString()}")
    return F.coalesce(column.cast("bigint"), F.lit(LOWEST))


def with_row_slices(
    df: DataFrame,
    unit: Sequence[str],
    order: Sequence[str],
    max_rows: int,
    width: int | None = None,
    name: str = "_slice",
) -> DataFrame:
    """Add the slice of each row: no slice has more than ``max_rows`` rows.

    ``width`` is the first span, in seconds for a timestamp and in units for a whole number.
    """
    if max_rows < 1:
        raise ValueError("a slice holds at least one row")
    unit, numbers = list(unit), [f"_n{k}" for k in range(len(order))]
    rows = df.withColumns({n: order_number(df, c) for n, c in zip(numbers, order, strict=True)})
    timed = isinstance(df.schema[order[0]].dataType, T.TimestampType)
    span = (width or SLICE_SECONDS) * 1_000_000 if timed else (width or SLICE_OFFSETS)
    first = F.col(numbers[0])
    rows = rows.withColumn(name, F.array(first - F.pmod(first, F.lit(span))))

    counted = rows
    while True:
        cuts = _cuts(counted, unit, numbers, max_rows, name).persist()
        if cuts.isEmpty():
            cuts.unpersist()
            return rows.drop(*numbers)
        at = reduce(lambda a, k: a.when(F.col("_by") == k, F.col(numbers[k])), range(len(numbers)), F)
        lower = F.col("_from") + F.floor((at - F.col("_from")) / F.col("_step")).cast("bigint") * F.col("_step")
        path = F.when(F.col("_step").isNull(), F.col(name)).otherwise(F.concat(name, F.array(lower)))
        joined = rows.join(cuts, [*unit, name], "left")
        counted = joined.filter(F.col("_step").isNotNull()).withColumn(name, path).drop("_by", "_from", "_step")
        rows = joined.withColumn(name, path).drop("_by", "_from", "_step")


def _cuts(rows: DataFrame, unit: list[str], numbers: list[str], max_rows: int, name: str) -> DataFrame:
    """Slices with too many rows: the order column that cuts them, from where, and in what steps."""
    ends = [f(n).alias(f"_{f.__name__}{n}") for n in numbers for f in (F.min, F.max)]
    found = rows.groupBy(*unit, name).agg(F.count(F.lit(1)).alias("_rows"), *ends)
    by, start, reach = F, F, F
    for k, n in enumerate(numbers):
        least, most = F.col(f"_min{n}"), F.col(f"_max{n}")
        by, start, reach = by.when(least < most, F.lit(k)), start.when(least < most, least), reach.when(least < most, most - least)
    parts = F.least(F.lit(MOST_PARTS), F.floor(F.col("_rows") / F.lit(max_rows)) * 2 + 2)
    # at least two parts hold rows, so cutting comes to an end
    step = F.greatest(F.lit(1), F.least(F.col("_reach"), F.ceil((F.col("_reach") + 1) / parts).cast("bigint")))
    return (
        found.filter(F.col("_rows") > max_rows)
        .select(*unit, name, by.alias("_by"), start.alias("_from"), reach.alias("_reach"), "_rows")
        .filter(F.col("_by").isNotNull())
        .select(*unit, name, "_by", "_from", step.cast("bigint").alias("_step"))
    )
