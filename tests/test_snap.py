from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from trackloom.operators.snap import RoadIndex, snap_to_road

M = 6371000.0 * math.pi / 180
ROADS = "seg_id bigint, x1 double, y1 double, x2 double, y2 double"
POINTS = "id bigint, latitude double, longitude double, tag string"


def brute(lat, lon, roads, radius):
    """Nearest position by trying every segment."""
    lat, lon = math.floor(lat * 1e6 + 0.5) / 1e6, math.floor(lon * 1e6 + 0.5) / 1e6
    shrink = math.cos(math.radians(lat))
    best = None
    for seg, x1, y1, x2, y2 in roads:
        dx, dy = (x2 - x1) * shrink, y2 - y1
        length2 = dx * dx + dy * dy
        t = ((lon - x1) * shrink * dx + (lat - y1) * dy) / length2 if length2 else 0.0
        t = min(max(t, 0.0), 1.0)
        near = (x1 + t * (x2 - x1), y1 + t * (y2 - y1))
        metres = math.hypot((near[0] - lon) * shrink, near[1] - lat) * M
        key = (math.floor(metres * 1e6 + 0.5), seg)
        if (radius is None or metres <= radius) and (best is None or key < best[0]):
            best = (key, near)
    return best


def check(spark, points, roads, radius):
    df = spark.createDataFrame([(k, lat, lon, "t") for k, (lat, lon) in enumerate(points)], POINTS)
    got = snap_to_road(df, spark.createDataFrame(roads, ROADS), radius, keep_hit=True).collect()
    assert len(got) == len(points)
    snapped = 0
    for row in got:
        lat, lon = points[row["id"]]
        best = brute(lat, lon, roads, radius)
        if best is None:
            assert row["seg_id"] is None
            assert (row["latitude"], row["longitude"]) == (lat, lon)
        else:
            snapped += 1
            assert row["road_metres"] == pytest.approx(best[0][0] / 1e6, abs=2e-6)
            assert row["seg_id"] == best[0][1]
            assert (row["longitude"], row["latitude"]) == pytest.approx(best[1], abs=1e-9)
        assert row["tag"] == "t"
    return snapped


@pytest.mark.parametrize(
    ("lat0", "lon0", "spread", "length", "radius"),
    [
        (42.65, 23.35, 0.02, 0.001, 5000.0),
        (42.65, 23.35, 0.3, 0.02, 5000.0),
        (-33.9, -70.6, 0.05, 0.003, 800.0),
        (0.0, 0.0, 0.02, 0.002, 5000.0),
        (69.6, 18.9, 0.2, 0.01, 20000.0),
        (-77.8, 166.6, 0.3, 0.05, 30.0),
    ],
)
def test_against_brute_force(spark, lat0, lon0, spread, length, radius):
    rng = random.Random(f"{lat0}{radius}")

    def near(scale):
        return rng.uniform(-scale, scale)

    roads = []
    for seg in range(60):
        x, y = lon0 + near(spread), lat0 + near(spread)
        roads.append((seg, x, y, x + near(length), y + near(length)))
    # Long, degenerate, axis-parallel and copied segments.
    roads.append((60, lon0 - spread, lat0 - spread, lon0 + spread, lat0 + spread))
    roads.append((61, lon0, lat0, lon0, lat0))
    roads.append((62, lon0, lat0 - spread, lon0, lat0 + spread))
    roads.append((63, *roads[5][1:]))
    roads.append((-1, *roads[7][1:]))
    points = [(lat0 + near(1.5 * spread), lon0 + near(1.5 * spread)) for _ in range(150)]
    # A car park: a third of all points within a few micro-degrees.
    points += [(lat0 + k % 5 * 1e-6, lon0 + 3e-4 + k % 3 * 1e-6) for k in range(80)]
    points += [(lat0 + 10 * spread, lon0), (lat0, lon0 - 15 * spread)]
    assert check(spark, points, roads, radius) > 20


def test_however_far(spark):
    """Without a radius every point finds a road: over the date line's side, near the poles, round the world."""
    rng = random.Random(8)
    roads = [(k, x, y, x + rng.uniform(0, 0.02), y + rng.uniform(0, 0.02)) for k, (x, y) in enumerate((rng.uniform(-170, 170), rng.uniform(-80, 80)) for _ in range(25))]
    roads += [(100 + k, 23.3 + k * 1e-3, 42.6, 23.3 + k * 1e-3, 42.61) for k in range(10)]
    points = [(42.6 + d, 23.3) for d in (0.0, 0.09, 0.9, 9.0, -60.0)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    points += [(90.0, 0.0), (-90.0, 12.0), (89.9999, -170.0), (89.5, 100.0), (0.0, 180.0), (0.0, -180.0)]
    assert check(spark, points, roads, None) == len(points)


def test_edges(spark):
    roads = [(7, 23.0, 42.0, 23.01, 42.0), (3, 23.0, 42.002, 23.01, 42.002), (9, 24.0, 42.0, 24.0, 42.0)]
    points = [(42.001, 23.005), (42.0, 24.001), (50.0, 23.0), (42.0, 23.005)]
    assert check(spark, points, roads, 5000.0) == 3


def test_undefined_coordinates_stay(spark):
    df = spark.createDataFrame([(1, float("nan"), 23.0, "n"), (2, float("inf"), 23.0, "i"), (3, 42.0, 23.001, "g")], POINTS)
    roads = spark.createDataFrame([(1, 23.0, 42.0, 23.0, 42.1), (2, 23.0, 0.0, 23.0, 0.1)], ROADS)
    got = {r["id"]: r for r in snap_to_road(df, roads).collect()}
    assert math.isnan(got[1]["latitude"]) and got[2]["latitude"] == math.inf
    assert got[3]["longitude"] == pytest.approx(23.0)


def test_no_roads_and_no_points(spark):
    df = spark.createDataFrame([(1, 42.0, 23.0, "g")], POINTS)
    roads = spark.createDataFrame([(1, 23.0, 42.0, 23.0, 42.1)], ROADS)
    assert snap_to_road(df, roads.filter("false")).first()["latitude"] == 42.0
    assert snap_to_road(df.filter("false"), roads).count() == 0


def test_stored_index_gives_the_same(spark, tmp_path):
    rng = random.Random(4)
    roads = spark.createDataFrame(
        [(k, 23 + rng.random() / 50, 42 + rng.random() / 50, 23 + rng.random() / 50, 42 + rng.random() / 50) for k in range(40)], ROADS
    )
    points = spark.createDataFrame([(k, 42 + rng.random() / 40, 23 + rng.random() / 40, "") for k in range(60)], POINTS)
    RoadIndex.build(roads).write(str(tmp_path / "index"))
    stored = RoadIndex.read(spark, str(tmp_path / "index"))
    assert sorted(snap_to_road(points, roads).collect()) == sorted(snap_to_road(points, stored).collect())


def test_a_stored_index_is_read_by_tiles(spark, tmp_path):
    """Points of one city touch the files around it; results are those of the whole index, far points included."""
    rng = random.Random(12)
    cities = [(23.3, 42.6), (2.35, 48.85), (-0.1, 51.5), (139.7, 35.7), (-70.6, -33.4)]
    lines = []
    for k, (x, y) in enumerate(cities):
        for j in range(60):
            ax, ay = x + rng.uniform(-0.3, 0.3), y + rng.uniform(-0.3, 0.3)
            lines.append((100 * k + j, ax, ay, ax + rng.uniform(-0.01, 0.01), ay + rng.uniform(-0.01, 0.01)))
    roads = spark.createDataFrame(lines, "seg_id bigint, x1 double, y1 double, x2 double, y2 double")
    RoadIndex.build(roads).write(str(tmp_path / "index"))
    stored = RoadIndex.read(spark, str(tmp_path / "index"))

    def points(places):
        return spark.createDataFrame([(k, y, x) for k, (x, y) in enumerate(places)], "id int, latitude double, longitude double")

    def snapped(df, index):
        return sorted(map(tuple, snap_to_road(df, index, keep_hit=True).collect()))

    city = points([(23.3 + rng.uniform(-0.4, 0.4), 42.6 + rng.uniform(-0.4, 0.4)) for _ in range(40)])
    near = stored.around(city)
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    for whole, part in ((stored.cells, near.cells), (stored.segments, near.segments)):
        assert 0 < files(part) < files(whole)
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "tile" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert snapped(city, near) == snapped(city, stored) == snapped(city, RoadIndex.build(roads))
    # no road within the tile: the whole index
    far = points([(23.3, 42.6), (60.0, 10.0), (float("nan"), 1.0)])
    assert stored.around(far) is stored
    assert repr(snapped(far, stored.around(far))) == repr(snapped(far, RoadIndex.build(roads)))
    assert RoadIndex.build(roads).around(city).tiled is False
