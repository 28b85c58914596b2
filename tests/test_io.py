from __future__ import annotations

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import one_column
from tests.test_decode import GOOD, raw
from tests.test_routes import track_of
from trackloom import sources
from trackloom.functions import vehicle_key
from trackloom.operators import decode, export
from trackloom.schemas import EXPORT_COLUMNS, RAW_FIELDS


def lines(folder, pattern="part-*"):
    found = []
    for path in sorted(glob.glob(f"{folder}/{pattern}")):
        with open(path, encoding="utf-8", newline="") as file:
            found += file.read().splitlines()
    return found


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('veh_id,lat,lon,ts,status\nA1,42.5,23.5,1738073454975,"on, task"\n,42.5,23.5,1,x\nA2,,23.5,1,x\n', encoding="utf-8")
    df = sources.read_raw_csv(spark, str(path))
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert df.columns == ["veh_id", "lat", "lon", "ts", "status"]
    good = decode.validate_raw(df).collect()
    assert [tuple(r) for r in good] == [("A1", "42.5", "23.5", "1738073454975", "on, task")]
    named = sources.read_raw_csv(spark, str(path), ["veh_id", "lat", "lon", "ts", "status"])
    assert named.count() == 3
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_raw_csv(spark, str(path), ["lat", "veh_id", "lon", "ts", "status"]).collect()


def test_starting_offsets():
    assert json.loads(sources.starting_offsets("gps", {0: 23, 7: 5})) == {"gps": {"0": 23, "7": 5}}


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("k:v", ("k", "v")),
        ("  k:a:b:c \r", ("k", "a:b:c")),
        (":v", ("", "v")),
        ("k:", ("k", "")),
        ("none", None),
        ("", None),
    ],
)
def test_split(spark, line, expected):
    rows = export.split_key_value(one_column(spark, [line], "value")).collect()
    assert [tuple(r) for r in rows] == ([expected] if expected else [])


def test_export_chain(spark, tmp_path):
    """Smoothed fixes to keyed lines, back to rows, to CSV."""
    fixes = track_of(spark, [0, 40]).unionByName(track_of(spark, [7], "other"))
    fixes = fixes.withColumn("after_offset", F.col("offset")).withColumn("j", F.lit(0))
    sources.write_keyed_lines(sources.smoothed_messages(fixes), str(tmp_path / "lines"))
    text = lines(tmp_path / "lines")
    assert len(text) == 3 and all(t.split(":", 1)[0] in ("d", "other") for t in text)
    back = sources.read_keyed_lines(spark, str(tmp_path / "lines"))
    flat = export.flatten_export(export.filter_key(back, "d"))
    sources.write_csv(flat, str(tmp_path / "csv"))
    rows = [row for part in sorted(glob.glob(f"{tmp_path}/csv/part-*")) for row in csv.DictReader(open(part, encoding="utf-8", newline=""))]
    assert list(rows[0]) == list(EXPORT_COLUMNS)
    assert sorted(r["timestamp"] for r in rows) == ["2025-01-28T14:00:00+00:00", "2025-01-28T14:00:05+00:00"]
    assert {(r["device_id"], r["status"], float(r["altitude"]), r["signal"]) for r in rows} == {("d", "on task", 5.0, "6")}


def test_messages_of_a_key_stay_in_order(spark):
    fixes = track_of(spark, list(range(30))).withColumn("after_timestamp", F.col("timestamp"))
    fixes = fixes.withColumn("after_offset", F.col("offset")).withColumn("j", F.lit(0)).repartition(7)
    for one_writer in (True, False):
        sent = sources.smoothed_messages(fixes, one_writer_per_key=one_writer).collect()
        assert [json.loads(r["value"])["Speed"] for r in sent] == [10.0 * (k + 1) for k in range(30)]


@pytest.mark.parametrize(
    "value",
    ['{"Timestamp":"xyz"}', '{"Latitude":1.5,"Other":[1,{"a":2}]}', "{}"],
)
def test_flatten_accepts(spark, value):
    row = export.flatten_export(spark.createDataFrame([("k", value)], "key string, value string")).first()
    data = json.loads(value)
    assert row["timestamp"] == data.get("Timestamp", "")
    assert row["latitude"] == str(data.get("Latitude", ""))
    assert row["status"] == ""


@pytest.mark.parametrize("value", ["[1]", '"x"', "null", "{", '{"a":1} x', "", "12"])
def test_flatten_drops(spark, value):
    assert export.flatten_export(spark.createDataFrame([("k", value)], "key string, value string")).count() == 0


def test_csv_of_null_and_empty(spark, tmp_path):
    values = ["", None, 'say "x", y', *[""] * 9]
    row = spark.createDataFrame([tuple(values)], ", ".join(f"{name} string" for name in EXPORT_COLUMNS))
    sources.write_csv(row.coalesce(1), str(tmp_path / "csv"))
    assert lines(tmp_path / "csv") == [",".join(EXPORT_COLUMNS), ',,"say ""x"", y",' + "," * 8]


def test_raw_messages(spark):
    sent = sources.raw_messages(raw(spark, {}, {"veh_id": ""}, {"veh_id": None})).collect()
    assert len(sent) == 1
    assert json.loads(sent[0]["value"]) == GOOD
    assert list(json.loads(sent[0]["value"])) == RAW_FIELDS
    assert sent[0]["key"] == one_column(spark, ["A1"]).select(vehicle_key(F.col("x"))).first()[0]


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    from trackloom.sources.readers import read_raw_csv

    (tmp_path / "in.csv").write_text('lat,veh_id\n"1","say ""hi"", ok"\n"2","two\nlines"\n')
    rows = read_raw_csv(spark, str(tmp_path / "in.csv"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'say "hi", ok'), ("2", "two\nlines")]
    (tmp_path / "one.csv").write_text('lat,veh_id\n"1","say ""hi"", ok"\n')
    assert [tuple(r) for r in read_raw_csv(spark, str(tmp_path / "one.csv"), ["lat", "veh_id"]).collect()] == [("1", 'say "hi", ok')]
