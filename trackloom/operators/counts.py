"""Counts of the raw feed. All are partial aggregates before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_vehicle(rows: DataFrame) -> DataFrame:
    return rows.groupBy("veh_id").agg(F.count(F.lit(1)).alias("messages"))


def total_messages(rows: DataFrame) -> DataFrame:
    """Sum of the per-vehicle counts."""
    total = F.coalesce(F.sum("messages"), F.lit(0)).cast("bigint")
    return count_per_vehicle(rows).agg(total.alias("total_messages"))


def count_vehicles(valid_rows: DataFrame) -> DataFrame:
    return valid_rows.agg(F.count_distinct("veh_id").alias("vehicles"))
