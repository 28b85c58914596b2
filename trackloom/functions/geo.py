"""Distances and positions on the earth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_M = 6371000.0
METRES_PER_DEGREE = 111194.92664455873  # EARTH_RADIUS_M * pi / 180
MICRO = 1e6


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    # pow names its argument once, where a product would repeat the sine.
    across = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0))
    along = F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    a = across + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * along
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def micro_degrees(degrees: Column) -> Column:
    """A coordinate at six decimals as a whole number, so that it can be a join key."""
    return F.floor(degrees * F.lit(MICRO) + F.lit(0.5)).cast("bigint")


def mean_speed(a: Column, b: Column) -> Column:
    return (a + b) / 2


def latitude_shrink(lat: Column) -> Column:
    """Length of a degree east-west at a latitude, as a share of one north-south."""
    return F.cos(F.radians(lat))


def with_nearest_on_segment(df: DataFrame, lon: Column, lat: Column, shrink: Column) -> DataFrame:
    """Nearest position on the segment ``x1, y1, x2, y2``, on a plane scaled at the point's latitude.

    Adds ``hit_lon``, ``hit_lat`` and ``hit_m`` (metres). The steps are columns of their
    own, so that each is computed once.
    """
    x1, y1 = F.col("x1"), F.col("y1")
    dx, dy = (F.col("x2") - x1) * shrink, F.col("y2") - y1
    length2 = F.col("_length2")
    along = ((lon - x1) * shrink * dx + (lat - y1) * dy) / length2
    share = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    off_x, off_y = (F.col("hit_lon") - lon) * shrink, F.col("hit_lat") - lat
    metres = F.sqrt(F.pow(off_x, F.lit(2.0)) + F.pow(off_y, F.lit(2.0)))
    return (
        df.withColumn("_length2", dx * dx + dy * dy)
        .withColumn("_share", F.when(length2 > 0, share).otherwise(F.lit(0.0)))
        .withColumns(
            {
                "hit_lon": x1 + F.col("_share") * (F.col("x2") - x1),
                "hit_lat": y1 + F.col("_share") * (F.col("y2") - y1),
            }
        )
        .withColumn("hit_m", metres * F.lit(METRES_PER_DEGREE))
        .drop("_length2", "_share")
    )
