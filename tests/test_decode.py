from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import one_column
from trackloom.operators import decode
from trackloom.schemas import OUTPUT_NAMES, RAW_FIELDS

GOOD = {
    "lat": "42.65",
    "lon": "23.35",
    "ts": "1738073454975",
    "dev_id": "0040",
    "speed": "12.5",
    "alt": "598.8",
    "signal": "31",
    "sats": "8",
    "status": "on task",
    "in_depot": "False",
    "veh_id": "A1",
    "formatted_ts": "x",
}


def raw(spark, *changes):
    rows = [tuple({**GOOD, **change}[name] for name in RAW_FIELDS) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in RAW_FIELDS))


@pytest.mark.parametrize("text", ["not json", "[1]", '[{"lat":"1"}]', "null", "", '{"lat":"1"', '"x"', "7", None])
def test_bad_json(spark, text):
    row = decode.decode_raw(one_column(spark, [text], "value")).first()
    assert row["error"] == decode.NOT_AN_OBJECT


def test_good_json_ignores_unknown_and_fills_missing(spark):
    text = json.dumps({"lat": "1.5", "current_ts": 5, "status": None, "veh_id": "V"})
    row = decode.decode_raw(one_column(spark, [text], "value")).first()
    assert row["error"] is None
    assert (row["lat"], row["status"], row["veh_id"], row["lon"]) == ("1.5", "", "V", "")


@pytest.mark.parametrize(
    ("text", "lenient", "strict"),
    [
        ('{"lat":1.5}', True, False),
        ('{"lat":"1.5"} x', False, False),
        ('{"lat":"1"} {"lat":"2"}', False, False),
        ('{"lat":"1"}}', False, False),
        ('{"lat":"1"},{"lat":"2"}', False, False),
        ('{"lat":"1"}, "y":{"lat":"2"}', False, False),
        ('{"lat":"1"}],[{"lat":"2"}', False, False),
        (' {"lat":"1"} ', True, True),
        ('{"lat":"1.5","sats":null}', True, True),
        ('{"lat":"1.5","current_ts":7}', True, True),
    ],
)
def test_strict(spark, text, lenient, strict):
    df = one_column(spark, [text], "value")
    assert (decode.decode_raw(df, lenient=True).first()["error"] is None) == lenient
    assert (decode.decode_raw(df).first()["error"] is None) == strict


def test_validation_reasons(spark):
    changes = [{}, {"lat": ""}, {"lon": "", "ts": ""}, {"ts": ""}, {"veh_id": ""}, {"lat": "abc"}, {"ts": "1.5"}, {"lat": " 42.5 "}, {"speed": "bad"}, {"lat": "1_000"}, {"lat": None}]
    got = [r["error"] for r in decode.with_validation_error(raw(spark, *changes)).collect()]
    assert got == [
        None,
        "Missing required field: lat",
        "Missing required field: lon",
        "Missing required field: ts",
        "Missing required field: veh_id",
        "Invalid numeric values",
        "Invalid numeric values",
        None,
        None,
        "Invalid numeric values",
        "Missing required field: lat",
    ]
    assert decode.validate_raw(raw(spark, *changes)).count() == 3


def test_validation_without_a_required_column(spark):
    row = decode.with_validation_error(raw(spark, {}).drop("ts")).first()
    assert row["error"] == "Missing required field: ts"


def test_processed(spark):
    row = decode.to_processed(raw(spark, {})).first()
    assert row["error"] is None
    assert (row["latitude"], row["speed"], row["signal"], row["satellites"]) == (42.65, 12.5, 31, 8)
    assert row["timestamp"] == dt.datetime(2025, 1, 28, 14, 10, 54, 975000)
    assert (row["device_id"], row["vehicle_id"], row["in_depot"]) == ("0040", "A1", "False")


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({"speed": ""}, "bad speed: "),
        ({"lat": "1.5d"}, "bad latitude: 1.5d"),
        ({"lat": "x", "sats": "y"}, "bad latitude: x"),
        ({"alt": "1e400"}, "bad altitude: 1e400"),
        ({"signal": "31.0"}, "bad signal: 31.0"),
        ({"sats": "9223372036854775808"}, "bad satellites: 9223372036854775808"),
        ({"ts": "9223372036854775807"}, "bad timestamp: 9223372036854775807"),
        ({"ts": "1.5", "signal": "+31"}, "bad timestamp: 1.5"),
    ],
)
def test_first_error_wins(spark, change, error):
    assert decode.to_processed(raw(spark, change)).first()["error"] == error


def test_decode_error_outlives_typing(spark):
    row = decode.to_processed(decode.decode_raw(one_column(spark, ["oops"], "value"))).first()
    assert row["error"] == decode.NOT_AN_OBJECT


@pytest.mark.parametrize("bounded", [True, False])
def test_quarantine(spark, bounded):
    rows = spark.createDataFrame(
        [(0, 0, 1, None), (0, 0, 2, "bad"), (0, 0, 3, None), (0, 1, 4, None), (1, 0, 5, None)],
        "partition int, batch_id bigint, id int, error string",
    )
    kept, rejected = decode.quarantine_batches(rows, bounded=bounded)
    assert sorted(r["id"] for r in kept.collect()) == [4, 5]
    assert sorted(r["id"] for r in rejected.collect()) == [1, 2, 3]
    kept, rejected = decode.quarantine_batches(rows, on_error="drop_row")
    assert sorted(r["id"] for r in kept.collect()) == [1, 3, 4, 5]
    assert [r["id"] for r in rejected.collect()] == [2]
    with pytest.raises(ValueError):
        decode.quarantine_batches(rows, on_error="other")


def test_stamp(spark):
    row = decode.stamp_ingest(raw(spark, {}), F.timestamp_millis(F.lit(1738073454975))).first()
    assert (row["current_ts"], row["formatted_ts"]) == (1738073454975, "2025-01-28 14:10:54")
    assert decode.stamp_ingest(raw(spark, {})).first()["current_ts"] > 1738073454975


def test_encode_order_and_non_finite(spark):
    good = decode.to_processed(raw(spark, {}, {"lat": "NaN"}, {"speed": "inf"}, {"alt": "-Infinity"}))
    rows = decode.encode_output(good).collect()
    assert len(rows) == 1
    message = json.loads(rows[0]["value"])
    assert rows[0]["key"] == "0040"
    assert list(message) == list(OUTPUT_NAMES.values())
    assert message["Timestamp"] == "2025-01-28T14:10:54.975Z"
    assert (message["Latitude"], message["Signal"], message["InDepot"]) == (42.65, 31, "False")
