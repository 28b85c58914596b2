"""Keeping rows by a computed column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """As ``df.filter(condition)``, but evaluated in place.

    A filter on a computed column moves below its computation and repeats it there: the
    JSON parse or all casts would run twice. Unpacking an array of one element or none
    keeps each computed once, and unused columns are still pruned.
    """
    one_or_none = F.when(condition, F.array(F.lit(0)))
    return df.select("*", F.explode(one_or_none).alias("_kept")).drop("_kept")
