"""Filling gaps with points of the road route between two fixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions import add_seconds, haversine_m, mean_speed, micro_degrees, ratio_step
from trackloom.operators.track import (
    GAP_METRES,
    ORDER,
    UNIT,
    consecutive_pairs,
    longer_than,
    segment_distance,
)
from trackloom.schemas import FIX_COLUMNS

# Target number of points per gap, and their least distance from both ends.
MAX_POINTS = 5
END_METRES = 20.0

ROUTE_KEY = ("o_lon", "o_lat", "d_lon", "d_lat")
NO_ROUTE = "no route found"


def first_in_list(rows: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """The first answer of each key. Later answers are dropped before the shuffle."""
    rest = [name for name in rows.columns if name not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col(rank)).alias("_first"))
        .select(*keys, *[F.col(f"_first.{name}").alias(name) for name in rest])
    )


def first_routes(routes: DataFrame) -> DataFrame:
    """One route per key: the lowest ``route_no``, or the smallest geometry without one."""
    rank = "route_no" if "route_no" in routes.columns else "coordinates"
    return first_in_list(routes, ROUTE_KEY, rank).select(*ROUTE_KEY, "coordinates")


def _place(mlon: Column, mlat: Column) -> Column:
    """A micro-degree coordinate as one number; null off the map."""
    on_map = (F.abs(mlon) <= 180_000_000) & (F.abs(mlat) <= 90_000_000)
    return F.when(on_map, (mlon + 180_000_000) * 180_000_001 + (mlat + 90_000_000))


def route_lookup(gaps: DataFrame, routes: DataFrame, unique: bool = False) -> DataFrame:
    """Add ``coordinates`` of the route from each fix to its ``next``; ``error`` if there is none.

    Both sides are exchanged on (origin, destination) right before the join, so that
    Spark's skew join can split a gap that occurs very often. ``unique`` says that the
    route table has one row per key, which saves finding the first.
    """
    ends = {
        "_origin": _place(micro_degrees(F.col("longitude")), micro_degrees(F.col("latitude"))),
        "_target": _place(
            micro_degrees(F.col("next.longitude")), micro_degrees(F.col("next.latitude"))
        ),
    }
    keyed = (routes if unique else first_routes(routes)).select(
        _place(F.col("o_lon"), F.col("o_lat")).alias("_origin"),
        _place(F.col("d_lon"), F.col("d_lat")).alias("_target"),
        "coordinates",
    )
    return (
        gaps.withColumns(ends)
        .join(keyed, list(ends), "left")
        .withColumn("error", F.when(F.col("coordinates").isNull(), F.lit(NO_ROUTE)))
        .drop(*ends)
    )


def inner_coordinates(coordinates: Column) -> Column:
    """The route without its first and last coordinate."""
    return F.slice(coordinates, F.lit(2), F.greatest(F.size(coordinates) - 2, F.lit(0)))


def sampled_indices(coordinates: Column, max_points: int = MAX_POINTS) -> Column:
    """0-based indices into the inner coordinates that the step rule keeps; null if none.

    Every ``step``-th one from ``step`` on. That is up to twice ``max_points``, since the
    step is rounded down, and never the first inner coordinate.
    """
    length = F.size(coordinates) - 2
    step = ratio_step(length, max_points + 1)
    return F.when(length > step, F.sequence(step, length - 1, step))


def explode_route(rows: DataFrame) -> DataFrame:
    """One row per inner coordinate: ``i`` from 1 along the route, ``lon``, ``lat``."""
    return _points_at(rows, F.when(F.size("coordinates") > 2, F.sequence(F.lit(0), F.size("coordinates") - 3)))


def sample_step(rows: DataFrame, max_points: int = MAX_POINTS) -> DataFrame:
    """As ``explode_route``, for the inner coordinates that the step rule keeps."""
    return _points_at(rows, sampled_indices(F.col("coordinates"), max_points))


def _points_at(rows: DataFrame, indices: Column) -> DataFrame:
    others = [name for name in rows.columns if name != "coordinates"]
    spot = F.element_at("coordinates", F.col("_r") + 2)
    return (
        rows.select("*", F.explode(indices).alias("_r"))
        .select(*others, (F.col("_r") + 1).alias("i"), spot.alias("_spot"))
        .select(*others, "i", F.col("_spot.lon").alias("lon"), F.col("_spot.lat").alias("lat"))
    )


def filter_near_ends(rows: DataFrame, metres: float = END_METRES) -> DataFrame:
    """Keep route points more than ``metres`` away from both original fixes."""
    lat, lon = F.col("lat"), F.col("lon")
    from_start = haversine_m(lat, lon, F.col("latitude"), F.col("longitude"))
    from_end = haversine_m(lat, lon, F.col("next.latitude"), F.col("next.longitude"))
    return rows.filter(longer_than(from_start, metres) & longer_than(from_end, metres))


def impute_fields(rows: DataFrame) -> DataFrame:
    """Route points as fixes; ``j`` is their place on the route, all unknowns zero or empty."""
    fields = {
        "latitude": F.col("lat"),
        "longitude": F.col("lon"),
        "speed": mean_speed(F.col("speed"), F.col("next.speed")),
        "altitude": F.lit(0.0),
        "signal": F.lit(0).cast("bigint"),
        "satellites": F.lit(0).cast("bigint"),
        "timestamp": add_seconds(F.col("timestamp"), F.col("i")),
        "device_id": F.col("device_id"),
        "vehicle_id": F.col("vehicle_id"),
        "status": F.lit(""),
        "in_depot": F.lit(""),
        "formatted_ts": F.lit(""),
    }
    others = [
        name for name in rows.columns if name not in (*FIX_COLUMNS, "next", "i", "lon", "lat", "error")
    ]
    return rows.select(
        *others, F.col("i").alias("j"), *[fields[name].alias(name) for name in FIX_COLUMNS]
    )


def find_gaps(pairs: DataFrame, gap_metres: float = GAP_METRES) -> DataFrame:
    """Pairs further apart than the threshold; the filter runs before any route is looked up."""
    return segment_distance(pairs).filter(longer_than(F.col("metres"), gap_metres)).drop("metres")


def fill_gaps(
    gaps_with_routes: DataFrame, max_points: int = MAX_POINTS, end_metres: float = END_METRES
) -> DataFrame:
    """Inserted fixes of the gaps that have a route."""
    sampled = sample_step(gaps_with_routes, max_points)
    return impute_fields(filter_near_ends(sampled, end_metres))


def impute_gaps(
    points: DataFrame,
    routes: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    width: int | None = None,
    gap_metres: float = GAP_METRES,
    bounded: bool = False,
) -> DataFrame:
    """The inserted fixes of a set of tracks. Gaps without a route give none.

    The order columns of the fix a point follows come along as ``after_<name>``, since
    an inserted timestamp may pass the next fix.
    """
    keyed = points.withColumns({f"after_{name}": F.col(name) for name in order})
    pairs = consecutive_pairs(keyed, unit, order, width=width, bounded=bounded)
    return fill_gaps(route_lookup(find_gaps(pairs, gap_metres), routes))


def append_imputed(fixes: DataFrame, inserted: DataFrame) -> DataFrame:
    """All fixes and all inserted points, duplicates kept."""
    return fixes.unionByName(inserted)
