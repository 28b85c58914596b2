from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.test_decode import GOOD
from tests.test_routes import ROUTE, roads, track_of
from tests.test_streaming import DEGREE, ONCE
from trackloom.operators.offsets import start_from
from trackloom.sources import (
    one_of_each,
    read_stream,
    read_topic_bounded,
    register_file_topic,
    smoothed_messages,
    starting_offsets,
    write_topic,
)
from trackloom.streaming import smooth_stream, topic_messages

FORMAT = {"format": "filetopic"}


@pytest.fixture
def servers(spark, tmp_path):
    register_file_topic(spark)
    return str(tmp_path / "broker")


def send(spark, servers, messages, topic="gps"):
    write_topic(spark.createDataFrame(messages, "key string, value string").coalesce(1), servers, topic, **FORMAT)


def read_back(spark, servers, topic="gps", **options):
    return read_topic_bounded(spark, servers, topic, **options, **FORMAT)


def test_what_is_written_is_read(spark, servers):
    first = [(f"k{k % 7}", f"v{k}") for k in range(100)]
    send(spark, servers, [*first, (None, "no key"), ("nothing", None)])
    send(spark, servers, [("k1", "later")])
    rows = read_back(spark, servers).collect()
    assert sorted((r["key"] or "", r["value"] or "") for r in rows) == sorted([*first, ("", "no key"), ("nothing", ""), ("k1", "later")])
    # offsets have no hole, a key keeps its order, and a key has one partition
    by_partition: dict = {}
    for r in rows:
        by_partition.setdefault(r["partition"], []).append(r["offset"])
    assert all(sorted(o) == list(range(len(o))) for o in by_partition.values())
    ones = sorted((r["offset"], r["value"]) for r in rows if r["key"] == "k1")
    assert [v for _, v in ones] == [f"v{k}" for k in range(1, 100, 7)] + ["later"]
    assert read_back(spark, servers, topic="empty").count() == 0


def test_bounded_read_from_given_offsets(spark, servers):
    send(spark, servers, [(f"k{k}", str(k)) for k in range(60)])
    whole = read_back(spark, servers)
    starts = {p: 2 for p in range(10)}
    found = read_back(spark, servers, starting=starting_offsets("gps", starts))
    table = spark.createDataFrame([(p, o) for p, o in starts.items()], "partition int, offset bigint")
    shown = lambda df: sorted(map(tuple, df.select("partition", "offset", "value").collect()))
    assert shown(found) == shown(start_from(whole, table))
    assert read_back(spark, servers, starting="latest").count() == 0


def run_stream(spark, servers, tmp_path, **options):
    seen = []

    def note(rows, epoch):
        seen.append((epoch, rows.count()))
        rows.write.mode("append").parquet(str(tmp_path / "seen"))

    source = read_stream(spark, servers, "gps", **options, **FORMAT)
    query = source.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    return [n for _, n in seen]


def test_stream_in_bounded_parts_and_restart(spark, servers, tmp_path):
    send(spark, servers, [(f"k{k}", str(k)) for k in range(25)])
    bounded = {"starting": "earliest", "max_messages": 10, "options": {"progress": str(tmp_path / "progress")}}
    assert run_stream(spark, servers, tmp_path, **bounded) == [10, 10, 5]
    send(spark, servers, [("k3", "more")])
    assert run_stream(spark, servers, tmp_path, **bounded) == [1]
    values = [r["value"] for r in spark.read.parquet(str(tmp_path / "seen")).collect()]
    assert sorted(values) == sorted([*map(str, range(25)), "more"])


def test_smoothing_from_topic_to_topic(spark, servers, tmp_path):
    """The whole way: messages of a topic are smoothed to messages of another."""
    fixes = [{**GOOD, "lat": repr(42 + 10 * k / DEGREE), "lon": "23.0", "ts": str(1738073454975 + 5000 * k), "dev_id": f"D{k % 2}"} for k in range(12)]
    send(spark, servers, [("vehicle", json.dumps(f)) for f in fixes])
    source = read_stream(spark, servers, "gps", "earliest", **FORMAT)
    table = spark.createDataFrame([], ROUTE)
    query = smooth_stream(source, roads(spark), table, topic_messages(servers, "smooth", **FORMAT), str(tmp_path / "c"), trigger=ONCE)
    query.awaitTermination()
    out = read_back(spark, servers, "smooth").collect()
    assert sorted(json.loads(r["value"])["Timestamp"] for r in out) == sorted({json.loads(r["value"])["Timestamp"] for r in out})
    assert len(out) == 12 and {r["key"] for r in out} == {"D0", "D1"}
    for key in ("D0", "D1"):
        times = [json.loads(r["value"])["Timestamp"] for r in sorted(out, key=lambda r: r["offset"]) if r["key"] == key]
        assert times == sorted(times)


def test_a_failed_job_leaves_no_message(spark, servers):
    send(spark, servers, [("k", "before")])
    bad = spark.range(4, numPartitions=2).select(
        F.lit("k").alias("key"), F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("value")
    )
    with pytest.raises(Exception, match="stop"):
        write_topic(bad, servers, "gps", **FORMAT)
    assert [r["value"] for r in read_back(spark, servers).collect()] == ["before"]


def test_smoothed_messages_round_trip(spark, servers):
    rows = track_of(spark, [0, 10, 20]).withColumns({"after_offset": F.col("offset"), "j": F.lit(0)})
    write_topic(smoothed_messages(rows), servers, "smooth", **FORMAT)
    assert read_back(spark, servers, "smooth").count() == 3


def test_a_replayed_epoch_reads_back_as_once(spark, servers, tmp_path):
    rows = track_of(spark, [0, 10, 20]).withColumns({"after_offset": F.col("offset"), "j": F.lit(0), "partition": F.lit(3)})
    sink = topic_messages(servers, "smooth", **FORMAT)
    sink(rows, 5)
    sink(rows, 5)
    send(spark, servers, [("a", "x"), ("a", "x")], "smooth")
    headers = {"options": {"includeHeaders": "true"}}
    found = read_back(spark, servers, "smooth", **headers)
    assert found.count() == 8
    once = one_of_each(found)
    assert once.columns == found.columns
    assert sorted(r["value"] for r in once.collect()) == sorted([r["value"] for r in smoothed_messages(rows).collect()] + ["x", "x"])

    source = read_stream(spark, servers, "smooth", "earliest", **headers, **FORMAT)
    query = one_of_each(source, "1 hour").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start(str(tmp_path / "once"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "once")).count() == 5
