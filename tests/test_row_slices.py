from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_track import START, busy
from trackloom.operators import track
from trackloom.operators.row_slices import with_row_slices
from trackloom.operators.slices import with_next, with_position


def fullest(sliced, unit):
    return sliced.groupBy(*unit, "_slice").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("max_rows", [1, 3, 40, 10_000])
@pytest.mark.parametrize("width", [1, 900, 10**9])
def test_equals_the_whole_window(spark, max_rows, width):
    df, unit, order = busy(spark), ["device_id"], ["timestamp", "offset"]
    assert fullest(with_row_slices(df, unit, order, max_rows, width), unit) <= max_rows
    whole = Window.partitionBy("device_id").orderBy("timestamp", "offset")
    expected = df.select("offset", F.lead("offset").over(whole).alias("n"), F.row_number().over(whole).cast("bigint").alias("p"))
    expected = sorted(map(tuple, expected.collect()), key=str)
    nexts = with_next(df, unit, order, ["offset"], width, max_rows=max_rows)
    assert nexts.columns == [*df.columns, "next", "alone"]
    places = with_position(df, unit, order, "pos", width, max_rows)
    got = nexts.select("offset", F.col("next.offset").alias("n")).join(places.select("offset", "pos"), "offset")
    assert sorted(map(tuple, got.collect()), key=str) == expected
    alone = {r["device_id"] for r in nexts.filter("alone").collect()}
    assert alone >= {f"single{k}" for k in range(5)} and "hot" not in alone


def test_a_million_fixes_in_one_second(spark):
    """Most of them at one instant: cut by the offset, which lies close together or far apart."""
    n = 1_000_000
    moment = F.lit(START) + F.make_interval(secs=F.when(F.col("id") % 10 == 0, F.col("id") / n).otherwise(F.lit(0.5)))
    far = F.when(F.col("id") % 1000 == 7, F.col("id") * 10**11).otherwise(F.col("id"))
    df = spark.range(n, numPartitions=8).select(F.lit("hot").alias("device_id"), moment.alias("timestamp"), far.alias("offset"))
    sliced = with_row_slices(df, ["device_id"], ["timestamp", "offset"], 10_000)
    assert fullest(sliced, ["device_id"]) <= 10_000

    def digest(rows):
        return rows.agg(F.count("*"), F.sum(F.xxhash64("offset", "n").cast("decimal(38,0)"))).first()

    whole = df.select("offset", F.lead("offset").over(Window.partitionBy("device_id").orderBy("timestamp", "offset")).alias("n"))
    found = with_next(df, ["device_id"], ["timestamp", "offset"], ["offset"], max_rows=10_000)
    assert digest(found.select("offset", F.col("next.offset").alias("n"))) == digest(whole)


def test_ties_missing_values_and_no_rows(spark):
    schema = "u string, t timestamp, o bigint"
    rows = [("a", None, k % 3) for k in range(9)] + [("a", START, None), ("a", START, 1), ("b", None, None), ("c", START, 5)] * 2
    df = spark.createDataFrame(rows, schema)
    sliced = with_row_slices(df, ["u"], ["t", "o"], 3)
    sizes = {tuple(r["_slice"]): r["count"] for r in sliced.filter("u = 'a'").groupBy("_slice").count().collect()}
    # rows equal in every order column stay together
    assert sorted(sizes.values()) == [2, 2, 3, 3, 3] or max(sizes.values()) <= 3
    places = with_position(df, ["u"], ["t", "o"], "pos", max_rows=3)
    assert sorted(r["pos"] for r in places.filter("u = 'a'").collect()) == list(range(1, 14))
    found = [r["o"] for r in places.filter("u = 'a'").orderBy("pos").collect()]
    assert found == [0, 0, 0, 1, 1, 1, 2, 2, 2, None, None, 1, 1]
    assert with_row_slices(df.limit(0), ["u"], ["t", "o"], 1).count() == 0
    with pytest.raises(TypeError):
        with_row_slices(df, ["u"], ["u"], 5)
    with pytest.raises(ValueError):
        with_row_slices(df, ["u"], ["t"], 0)


def test_operators_with_bounded_rows(spark):
    df = busy(spark)
    shown = lambda d: sorted(map(str, d.collect()))
    plain, bounded = (track.gap_summary(df, max_rows=m).withColumn("path_metres", F.round("path_metres", 3)) for m in (None, 7))
    assert shown(plain) == shown(bounded)
    assert shown(track.unit_bounds(df)) == shown(track.unit_bounds(df, max_rows=7))
    assert shown(track.consecutive_pairs(df)) == shown(track.consecutive_pairs(df, max_rows=7))
    rows = df.withColumnRenamed("device_id", "veh_id")
    assert shown(track.every_nth(rows)) == shown(track.every_nth(rows, max_rows=7))
    assert shown(track.track_lists(rows, ["offset"], 50)) == shown(track.track_lists(rows, ["offset"], 50, max_rows=7))


def test_dates_are_cut(spark):
    rows = [("a", dt.date(2025, 1, 1) + dt.timedelta(days=k)) for k in range(50)]
    df = spark.createDataFrame(rows, "u string, d date")
    assert fullest(with_row_slices(df, ["u"], ["d"], 4), ["u"]) <= 4
