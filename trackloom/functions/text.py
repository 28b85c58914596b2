"""Keys and text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vehicle_key(vehicle_id: Column) -> Column:
    """SHA-256 of the id modulo 2**32, as decimal text."""
    last_32_bits = F.substring(F.sha2(vehicle_id, 256), -8, 8)
    return F.conv(last_32_bits, 16, 10)


def batch_key(partition: Column, offset: Column) -> Column:
    """``partition:offset``."""
    return F.concat_ws(":", partition.cast("string"), offset.cast("string"))


def has_text(column: Column, text: str) -> Column:
    return F.contains(column, F.lit(text))


def empty_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
