from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import one_column
from trackloom import functions as X

# Ten fixes of one vehicle and the distance in metres between them.
SAMPLE = [
    (42.651082, 23.357893),
    (42.65112, 23.358179),
    (42.651228, 23.358289),
    (42.651103, 23.35826),
    (42.650873, 23.358425),
    (42.651278, 23.35805),
    (42.650769, 23.358322),
    (42.651244, 23.358217),
    (42.651111, 23.358224),
    (42.651161, 23.357968),
]
STEPS = [23.769, 15.005, 14.100, 28.917, 54.485, 60.813, 53.511, 14.800, 21.662]


def test_haversine_on_sample(spark):
    pairs = [(*a, *b) for a, b in zip(SAMPLE, SAMPLE[1:])]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(X.haversine_m(*map(F.col, "abcd"))).collect()]
    assert [round(v, 3) for v in got] == STEPS
    assert round(sum(got), 3) == 287.061


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("1.5", 1.5),
        ("+.5", 0.5),
        ("5.", 5.0),
        ("-4.25e1", -42.5),
        ("Infinity", math.inf),
        ("-inf", -math.inf),
        ("1.5d", None),
        ("1.5f", None),
        ("1e400", None),
        (" 1.5", None),
        ("1_000", None),
        ("0x1p-2", None),
        ("", None),
        (".", None),
        ("-nan", None),
    ],
)
def test_strict_double(spark, text, value):
    assert one_column(spark, [text]).select(X.strict_double(F.col("x"))).first()[0] == value


def test_strict_double_nan(spark):
    assert math.isnan(one_column(spark, ["NaN"]).select(X.strict_double(F.col("x"))).first()[0])


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("31", 31),
        ("+31", 31),
        ("-3", -3),
        ("31.0", None),
        ("1e2", None),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None),
        (" 3", None),
        ("", None),
    ],
)
def test_strict_long(spark, text, value):
    assert one_column(spark, [text]).select(X.strict_long(F.col("x"))).first()[0] == value


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2025-01-28T14:10:54.975Z", "2025-01-28T14:10:54.975000+00:00"),
        ("2025-01-28T14:10:54Z", "2025-01-28T14:10:54+00:00"),
        ("2025-01-28T14:10:54.000Z", "2025-01-28T14:10:54+00:00"),
        ("2025-01-28T14:10:54.5+02:00", "2025-01-28T14:10:54.500000+02:00"),
        ("2025-01-28T14:10:54.25-05:30", "2025-01-28T14:10:54.250000-05:30"),
        ("2025-01-28T14:10:54", "2025-01-28T14:10:54"),
        ("2025-02-30T14:10:54Z", "2025-02-30T14:10:54Z"),
        ("xyz", "xyz"),
        ("", ""),
    ],
)
def test_iso_timestamp(spark, text, value):
    assert one_column(spark, [text]).select(X.iso_timestamp(F.col("x"))).first()[0] == value


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("1738073454975", "2025-01-28 14:10:54"),
        (" 1738073454975 ", "2025-01-28 14:10:54"),
        ("0", "1970-01-01 00:00:00"),
        ("-1", "1969-12-31 23:59:59"),
        ("99999999999999999", "99999999999999999"),
        ("soon", "soon"),
        ("1.5", "1.5"),
    ],
)
def test_readable_time(spark, text, value):
    assert one_column(spark, [text]).select(X.readable_time(F.col("x"))).first()[0] == value


def test_epoch_ms_and_range(spark):
    df = one_column(spark, [1738073454975, 9223372036854775807, -9223372036854775807], kind="bigint")
    got = [r[0] for r in df.select(F.unix_micros(X.from_epoch_ms(F.col("x")))).collect()]
    assert got == [1738073454975000, None, None]


def test_vehicle_key(spark):
    ids = ["A2317", "", "Пловдив", "x" * 300]
    got = [r[0] for r in one_column(spark, ids).select(X.vehicle_key(F.col("x"))).collect()]
    assert got[0] == "4026122400"
    assert got == [str(int(hashlib.sha256(i.encode()).hexdigest(), 16) % 2**32) for i in ids]


def test_micro_degrees(spark):
    df = one_column(spark, [42.6510824, -0.0000006, 180.0], kind="double")
    assert [r[0] for r in df.select(X.micro_degrees(F.col("x"))).collect()] == [42651082, -1, 180000000]


def test_add_seconds_and_batch_key(spark):
    start = dt.datetime(2025, 1, 28, 14, 10, 54, 975000)
    df = spark.createDataFrame([(start, 7, 3, 120)], "ts timestamp, i int, p int, o bigint")
    later, key = df.select(
        X.add_seconds(F.col("ts"), F.col("i")), X.batch_key(F.col("p"), F.col("o"))
    ).first()
    assert (later - start).total_seconds() == 7
    assert key == "3:120"


def test_mean_contains_and_missing(spark):
    df = spark.createDataFrame([(10.0, 20.0, "no OSRM answer", None)], "a double, b double, t string, n string")
    row = df.select(
        X.mean_speed(F.col("a"), F.col("b")),
        X.has_text(F.col("t"), "OSRM"),
        X.has_text(F.col("t"), "%"),
        X.empty_if_null(F.col("n")),
    ).first()
    assert tuple(row) == (15.0, True, False, "")
