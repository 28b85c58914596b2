from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_track import START
from trackloom.operators import routes
from trackloom.operators.smooth import smooth

POINT = (
    "device_id string, vehicle_id string, timestamp timestamp, offset bigint, latitude double, longitude double, "
    "speed double, altitude double, signal bigint, satellites bigint, status string, in_depot string, formatted_ts string"
)
ROUTE = "o_lon bigint, o_lat bigint, d_lon bigint, d_lat bigint, coordinates array<struct<lon:double,lat:double>>"
DEGREE = 6371000.0 * math.pi / 180


def track_of(spark, places, device="d"):
    """Fixes along a meridian: metres north of 42."""
    rows = [
        (device, "v", START + dt.timedelta(seconds=5 * k), k, 42 + m / DEGREE, 23.0, 10.0 * (k + 1), 5.0, 6, 7, "on task", "False", "f")
        for k, m in enumerate(places)
    ]
    return spark.createDataFrame(rows, POINT)


def micro(x):
    return math.floor(x * 1e6 + 0.5)


def route(start, end, inner):
    """A route between two places (metres north) through the given places."""
    def lat(m):
        return 42 + m / DEGREE

    line = [(23.0, lat(m)) for m in [start, *inner, end]]
    return (micro(23.0), micro(lat(start)), micro(23.0), micro(lat(end)), line)


def inserted(spark, places, *lines, **options):
    return sorted(
        routes.impute_gaps(track_of(spark, places), spark.createDataFrame(list(lines), ROUTE), **options).collect(),
        key=lambda r: (r["after_offset"], r["j"]),
    )


@pytest.mark.parametrize(
    ("length", "kept"),
    [(0, 0), (1, 0), (2, 1), (5, 4), (6, 5), (11, 10), (12, 5), (17, 8), (18, 5), (23, 7), (24, 5), (100, 6)],
)
def test_step_rule_counts(spark, length, kept):
    rows = spark.createDataFrame([(1,)], "id int").withColumn(
        "coordinates",
        F.transform(F.sequence(F.lit(0), F.lit(length + 1)), lambda k: F.struct(k.cast("double").alias("lon"), F.lit(0.0).alias("lat"))),
    )
    assert routes.sample_step(rows).count() == kept
    assert routes.explode_route(rows).count() == length


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(length=st.integers(0, 400))
def test_step_rule_indices(spark, length):
    rows = spark.createDataFrame([(1,)], "id int").withColumn(
        "coordinates",
        F.transform(F.sequence(F.lit(0), F.lit(length + 1)), lambda k: F.struct(k.cast("double").alias("lon"), F.lit(0.0).alias("lat"))),
    )
    step = max(1, length // 6)
    expected = [r + 1 for r in range(length) if r >= step and r % step == 0]
    got = sorted((r["i"], r["lon"]) for r in routes.sample_step(rows).collect())
    assert got == [(i, float(i)) for i in expected]


def test_short_arrays(spark):
    rows = spark.createDataFrame([(0, []), (1, [(1.0, 1.0)]), (2, [(1.0, 1.0), (2.0, 2.0)]), (3, None)], "id int, coordinates array<struct<lon:double,lat:double>>")
    assert routes.explode_route(rows).count() == 0
    sizes = {r["id"]: r["n"] for r in rows.select("id", F.size(routes.inner_coordinates(F.col("coordinates"))).alias("n")).collect()}
    assert (sizes[0], sizes[1], sizes[2]) == (0, 0, 0)


def test_threshold_of_gap(spark):
    assert inserted(spark, [0, 99], route(0, 99, [30, 50, 60])) == []
    assert [r["j"] for r in inserted(spark, [0, 101], route(0, 101, [30, 50, 60]))] == [2, 3]


def test_ends_and_fields(spark):
    got = inserted(spark, [0, 200], route(0, 200, [5, 19, 50, 100, 181, 190]))
    assert [r["j"] for r in got] == [3, 4]
    first = got[0]
    assert first["speed"] == 15.0
    assert first["timestamp"] == START + dt.timedelta(seconds=3)
    assert (first["device_id"], first["vehicle_id"]) == ("d", "v")
    assert (first["altitude"], first["signal"], first["satellites"]) == (0.0, 0, 0)
    assert (first["status"], first["in_depot"], first["formatted_ts"]) == ("", "", "")


def test_first_route_wins_and_missing_route(spark):
    lines = [(*route(0, 200, [50, 100]), 2), (*route(0, 200, [50, 100, 120, 140]), 1)]
    table = spark.createDataFrame(lines, ROUTE + ", route_no int")
    pairs = routes.find_gaps(routes.consecutive_pairs(track_of(spark, [0, 200, 500])))
    got = {r["offset"]: r for r in routes.route_lookup(pairs, table).collect()}
    assert len(got[0]["coordinates"]) == 6 and got[0]["error"] is None
    assert got[1]["coordinates"] is None and got[1]["error"] == routes.NO_ROUTE
    unique = routes.route_lookup(pairs, table.filter("route_no = 1"), unique=True).collect()
    assert {r["offset"]: r["error"] for r in unique} == {0: None, 1: routes.NO_ROUTE}


def roads(spark):
    """One road 10 m east of the meridian."""
    x = 23.0 + 10 / DEGREE / math.cos(math.radians(42))
    return spark.createDataFrame([(1, x, 41.9, x, 42.1)], "seg_id bigint, x1 double, y1 double, x2 double, y2 double")


@pytest.mark.parametrize("bounded", [True, False])
def test_smooth(spark, bounded):
    points = track_of(spark, [0, 50, 300]).unionByName(track_of(spark, [0], "single")).unionByName(track_of(spark, [0, 0], "twin"))
    points = points.unionByName(track_of(spark, [0, 900], "lost"))
    table = spark.createDataFrame([route(50, 300, [100, 150, 200])], ROUTE)
    rows = smooth(points, roads(spark), table, bounded=bounded).collect()
    shape = sorted((r["device_id"], r["after_offset"], r["j"]) for r in rows)
    assert shape == [("d", 0, 0), ("d", 1, 0), ("d", 1, 2), ("d", 1, 3), ("d", 2, 0), ("single", 0, 0), ("twin", 0, 0), ("twin", 1, 0)]
    by_key = {(r["device_id"], r["after_offset"], r["j"]): r for r in rows}
    assert by_key["single", 0, 0]["longitude"] == 23.0
    assert by_key["d", 0, 0]["longitude"] > 23.0001
    assert by_key["d", 0, 0]["altitude"] == 5.0
    assert by_key["d", 1, 2]["longitude"] == 23.0
    kept = smooth(points, roads(spark), table, on_missing_route="keep_gap", bounded=bounded).collect()
    assert len(kept) == len(rows) + 2
    with pytest.raises(ValueError):
        smooth(points, roads(spark), table, on_missing_route="other")


def test_smooth_of_nothing(spark):
    points = track_of(spark, [0]).filter("false")
    table = spark.createDataFrame([route(50, 300, [100])], ROUTE)
    assert smooth(points, roads(spark), table).count() == 0


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(places=st.lists(st.integers(0, 3000), min_size=2, max_size=12))
def test_smooth_properties(spark, places):
    pairs = {(a, b) for a, b in zip(places, places[1:])}
    lines = [route(a, b, [a + (b - a) * k / 20 for k in range(1, 20)]) for a, b in sorted(pairs)]
    rows = smooth(track_of(spark, places), roads(spark), spark.createDataFrame(lines, ROUTE)).collect()
    assert sorted(r["after_offset"] for r in rows if r["j"] == 0) == list(range(len(places)))
    for r in rows:
        if r["j"]:
            k = r["after_offset"]
            metres = (r["latitude"] - 42) * DEGREE
            # Places are whole metres, so a distance on the limit itself may fall either way.
            assert abs(places[k + 1] - places[k]) >= 100
            assert min(abs(metres - places[k]), abs(metres - places[k + 1])) > 20 - 1e-6


def test_smoothing_reports_the_units_it_sets_aside(spark):
    """A gap without a route removes its unit, whose fixes come back as they were."""
    from trackloom.operators.smooth import smooth_or_reject
    from trackloom.schemas import FIX_COLUMNS, PROCESSED, ROADS, ROUTES

    import datetime as dt

    def fix(lat, k):
        return (lat, 23.0, 5.0, 1.0, 1, 2, dt.datetime(2025, 1, 1, 0, 0, k), "D", "V", "s", "f", "x")

    rows = [(*fix(42.0, 0), 0, 0, 0), (*fix(42.0001, 1), 0, 0, 1), (*fix(42.0, 2), 0, 1, 2), (*fix(42.5, 3), 0, 1, 3)]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PROCESSED)
    points = spark.createDataFrame(rows, f"{kinds}, partition int, batch_id bigint, offset bigint")
    roads = spark.createDataFrame([(1, 23.001, 41.0, 23.001, 43.0)], ROADS)
    kept, lost = smooth_or_reject(points, roads, spark.createDataFrame([], ROUTES), ["partition", "batch_id"], ["offset"], bounded=True)
    assert {(r["after_offset"], round(r["longitude"], 6)) for r in kept.collect()} == {(0, 23.001), (1, 23.001)}
    assert {(r["after_offset"], r["longitude"], r["error"]) for r in lost.collect()} == {(2, 23.0, "no route found"), (3, 23.0, "no route found")}
    assert set(FIX_COLUMNS) <= set(lost.columns)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "LeftSemi" not in plan
