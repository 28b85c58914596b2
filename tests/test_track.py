from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_functions import SAMPLE
from trackloom.operators import counts, track
from trackloom.operators.slices import slice_start, with_next, with_position

START = dt.datetime(2025, 1, 28, 14, 0, 0)


def fixes(spark, rows):
    """Rows of (device, seconds, offset, lat, lon)."""
    data = [(d, START + dt.timedelta(seconds=s), o, lat, lon, 1.0) for d, s, o, lat, lon in rows]
    schema = "device_id string, timestamp timestamp, offset bigint, latitude double, longitude double, speed double"
    return spark.createDataFrame(data, schema)


def busy(spark, seed=1):
    """A third of the rows in one device, equal times, far gaps and single-fix devices."""
    rng = random.Random(seed)
    rows = []
    for offset in range(600):
        device = "hot" if offset % 3 == 0 else f"d{rng.randrange(40)}"
        seconds = rng.choice([rng.randrange(50), rng.randrange(20_000), rng.randrange(10**7)])
        rows.append((device, seconds, offset, 42.0 + rng.random(), 23.0))
    rows += [(f"single{k}", 100 * k, 1000 + k, 42.0, 23.0) for k in range(5)]
    rng.shuffle(rows)
    return fixes(spark, rows)


@pytest.mark.parametrize("width", [1, 60, 900, 86_400, 10**9])
def test_sliced_next_equals_whole_window(spark, width):
    df = busy(spark)
    whole = Window.partitionBy("device_id").orderBy("timestamp", "offset")
    expected = df.select(
        "offset",
        F.lead("offset").over(whole).alias("n"),
        (F.count("*").over(Window.partitionBy("device_id")) == 1).alias("alone"),
    )
    got = with_next(df, ["device_id"], ["timestamp", "offset"], ["offset"], width)
    assert got.columns == [*df.columns, "next", "alone"]
    shown = got.select("offset", F.col("next.offset").alias("n"), "alone")
    assert sorted(map(tuple, shown.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    bounded = with_next(df, ["device_id"], ["timestamp", "offset"], ["offset"], bounded=True)
    shown = bounded.select("offset", F.col("next.offset").alias("n"), "alone")
    assert sorted(map(tuple, shown.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


@pytest.mark.parametrize("width", [1, 7, 100, 10**6])
def test_sliced_position_equals_row_number(spark, width):
    df = busy(spark).withColumn("offset", F.col("offset") - 300)
    whole = Window.partitionBy("device_id").orderBy("offset")
    expected = df.select("offset", F.row_number().over(whole).cast("bigint"))
    got = with_position(df, ["device_id"], ["offset"], width=width).select("offset", "pos")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_slice_needs_time_or_number(spark):
    df = busy(spark)
    with pytest.raises(TypeError):
        slice_start(df, ["device_id"], None)


def test_gap_summary_on_sample(spark):
    rows = [("v", 5 * k, k, lat, lon) for k, (lat, lon) in enumerate(SAMPLE)]
    row = track.gap_summary(fixes(spark, rows)).first()
    assert (row["segments"], row["gaps"], round(row["path_metres"], 3)) == (9, 0, 287.061)


def test_nan_distance_is_no_gap(spark):
    rows = [("v", 0, 0, float("nan"), 23.0), ("v", 5, 1, 42.0, 23.0), ("v", 10, 2, 43.0, 23.0)]
    row = track.gap_summary(fixes(spark, rows)).first()
    assert (row["segments"], row["gaps"]) == (2, 1)


def test_unit_bounds(spark):
    rows = [("a", 0, 0, 1.0, 1.0), ("a", 0, 1, 1.0, 1.0), ("b", 0, 2, 1.0, 1.0)]
    got = {r["offset"]: (r["is_last"], r["alone"]) for r in track.unit_bounds(fixes(spark, rows)).collect()}
    assert got == {0: (False, False), 1: (True, False), 2: (True, True)}


def test_every_nth_and_lists(spark):
    rows = spark.createDataFrame([("v", k) for k in range(25)] + [("w", 99)], "veh_id string, offset bigint")
    assert sorted(r["offset"] for r in track.every_nth(rows, 10).collect()) == [9, 19]
    lists = {
        (r["veh_id"], r["part"]): [i["offset"] for i in r["items"]]
        for r in track.track_lists(rows, ["offset"], max_length=10).collect()
    }
    assert lists == {
        ("v", 0): list(range(10)),
        ("v", 1): list(range(10, 20)),
        ("v", 2): list(range(20, 25)),
        ("w", 0): [99],
    }


def test_counts(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "veh_id string")
    assert {tuple(r) for r in counts.count_per_vehicle(rows).collect()} == {("a", 2), ("b", 1)}
    assert counts.total_messages(rows).first()[0] == 3
    assert counts.count_vehicles(rows).first()[0] == 2
    empty = rows.filter("false")
    assert (counts.total_messages(empty).first()[0], counts.count_vehicles(empty).first()[0]) == (0, 0)


def test_output_order(spark):
    rows = spark.createDataFrame(
        [("b", START, 1, 0), ("a", START, 2, 3), ("a", START, 2, 0), ("a", START, 1, 0), ("a", START, 2, 1)],
        "device_id string, timestamp timestamp, offset bigint, j int",
    )
    got = [(r["device_id"], r["offset"], r["j"]) for r in track.output_order(rows).collect()]
    assert got == [("a", 1, 0), ("a", 2, 0), ("a", 2, 1), ("a", 2, 3), ("b", 1, 0)]
