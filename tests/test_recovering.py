from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.test_routes import POINT, ROUTE, roads, route, track_of
from tests.test_streaming import ONCE, message, put, source
from trackloom.operators.decode import encode_output
from trackloom.operators.offsets import batch_summary
from trackloom.operators.recovery import (
    merge_intervals,
    offset_intervals,
    retry_verdicts,
    unseen_messages,
)
from trackloom.operators.smooth import smooth
from trackloom.operators.track import every_nth
from trackloom.schemas import FIX_COLUMNS
from trackloom.sources import read_lines_stream
from trackloom.streaming import (
    Ledger,
    counting_step,
    device_step,
    lone_fixes,
    retry_waiting,
    retrying_step,
    start,
)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


# --- intervals ------------------------------------------------------------------------


def plain_intervals(pairs):
    out = []
    for p, o in sorted(set(pairs)):
        if out and out[-1][0] == p and out[-1][2] == o - 1:
            out[-1][2] = o
        else:
            out.append([p, o, o])
    return [tuple(i) for i in out]


@pytest.mark.parametrize("width", [1, 7, None])
def test_intervals(spark, width):
    rng = random.Random(3)
    pairs = [(rng.randrange(3), rng.randrange(-50, 200)) for _ in range(400)] + [(9, k) for k in range(1000)]
    rng.shuffle(pairs)
    found = offset_intervals(spark.createDataFrame(pairs, "partition int, offset bigint"), width)
    assert rows_of(found) == plain_intervals(pairs)
    assert (9, 0, 999) in rows_of(found)


def test_intervals_that_overlap(spark):
    rows = [(0, 0, 9), (0, 3, 4), (0, 10, 12), (0, 14, 20), (0, 0, 2), (1, 5, 5)]
    assert rows_of(merge_intervals(spark.createDataFrame(rows, "partition int, first bigint, last bigint"))) == [(0, 0, 12), (0, 14, 20), (1, 5, 5)]


def test_a_late_duplicate_is_known_and_the_state_stays_one_row(spark):
    state = spark.createDataFrame([], "partition int, first bigint, last bigint")
    for at in range(0, 500, 100):
        block = spark.createDataFrame([(0, k) for k in range(at, at + 100)] + [(0, 7), (0, 7)], "partition int, offset bigint")
        fresh = unseen_messages(block, state)
        assert fresh.count() == 100
        merged = merge_intervals(offset_intervals(fresh).unionByName(state))
        state = spark.createDataFrame(merged.collect(), merged.schema)
    assert rows_of(state) == [(0, 0, 499)]


@pytest.mark.parametrize("width", [1, 7, None])
def test_unseen_messages_of_any_blocks(spark, width):
    """Intervals that overlap, touch, run over many blocks or hold nothing; messages that come twice or lack a key."""
    rng = random.Random(5)
    spans = [(p, f, f + rng.choice([-1, 0, 0, 2, 9])) for p, f in ((rng.randrange(3), rng.randrange(-60, 200)) for _ in range(60))]
    spans += [(1, 40, 90), (1, 95, 96), (4, -(10**17), 10**17), (None, 0, 99), (5, None, 9), (5, 0, None), (6, 3, 3)]
    pairs = [(rng.randrange(6), rng.randrange(-80, 250)) for _ in range(800)] + [(None, 5), (None, None), (0, None), (6, 2), (6, 3), (6, 4)]

    def known(p, o):
        return None not in (p, o) and any(p == q and None not in (f, t) and f <= o <= t for q, f, t in spans)

    messages = spark.createDataFrame([(f"{p}:{o}", p, o) for p, o in pairs * 2], "`a.text` string, partition int, offset bigint")
    found = unseen_messages(messages, spark.createDataFrame(spans, "partition int, first bigint, last bigint"), width)
    assert found.columns == ["partition", "a.text", "offset"]
    assert sorted(r["a.text"] for r in found.collect()) == sorted(f"{p}:{o}" for p, o in set(pairs) if not known(p, o))


def test_a_message_does_not_meet_every_interval(spark):
    """No row carries a partition's intervals: with holes all over, messages times intervals is quadratic."""
    messages = spark.range(1000).selectExpr("0 as partition", "id as offset")
    found = unseen_messages(messages, offset_intervals(messages.filter("offset % 2 = 0")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "exists(" not in plan
    assert rows_of(found) == [(0, k) for k in range(1, 1000, 2)]


def test_verdicts(spark):
    rows = [(0, 0, "bad OSRM", 0), (0, 0, None, 0), (0, 1, "bad OSRM", 0), (0, 1, "bad speed", 0), (1, 0, "x", 2), (1, 1, None, 0), (1, 2, "OSRM", 9)]
    df = spark.createDataFrame(rows, "partition int, batch_id bigint, error string, attempts int")
    judged = {(r["partition"], r["batch_id"]): r["verdict"] for r in retry_verdicts(df, 3).collect()}
    assert judged == {(0, 0): "skip", (0, 1): "retry", (1, 0): "reject", (1, 1): "retry", (1, 2): "skip"}
    assert {r["verdict"] for r in retry_verdicts(df, None).filter("partition = 1").collect()} == {"retry", "skip"}


# --- the ledger -----------------------------------------------------------------------


def test_an_entry_counts_with_its_mark(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.latest == -1 and ledger.state("s", "x int").count() == 0
    one = spark.createDataFrame([(1,)], "x int")
    ledger.commit({"s": one, "l": one}, 0)
    # the next entry fails after its first table
    two = spark.createDataFrame([(2,)], "x int")
    two.write.parquet(str(tmp_path / "ledger" / "l" / "entry=1"))
    again = Ledger(spark, str(tmp_path / "ledger"))
    assert again.latest == 0 and rows_of(again.log("l")) == [(1, 0)]
    assert again.holds(0) and not again.holds(1)
    again.commit({"s": two, "l": one.limit(0)}, 1)
    assert rows_of(again.log("l")) == [(1, 0)] and rows_of(again.state("s", "x int")) == [(2,)]
    assert Ledger(spark, str(tmp_path / "ledger")).latest == 1


# --- retries --------------------------------------------------------------------------


def smooth_all(spark, tmp_path, table, checkpoint="checkpoint", **options):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    step = retrying_step(ledger, roads(spark), table, **options)
    start(source(spark, tmp_path / "in"), step, str(tmp_path / checkpoint), ONCE).awaitTermination()
    return ledger, step


def test_a_batch_succeeds_on_its_second_attempt(spark, tmp_path):
    """Partition 0 lacks a route at first. In partition 1 all errors name the engine: given up at once."""
    known = []

    def table():
        return spark.createDataFrame(known, ROUTE)

    first = [message(0, 0), message(2, 300), message(1, 0), message(3, 5, speed="OSRM is down")]
    put(tmp_path / "in", "a.txt", first)
    ledger, _ = smooth_all(spark, tmp_path, table)
    assert ledger.log("output").count() == 0
    waiting = ledger.state("retry", "partition int, offset bigint, value string, batch_id bigint, attempts int")
    assert [(r["partition"], r["offset"], r["batch_id"], r["attempts"]) for r in waiting.orderBy("offset").collect()] == [(0, 0, 0, 1), (0, 1, 0, 1)]
    assert {(r["partition"], r["verdict"]) for r in ledger.log("rejected").collect()} == {(1, "skip")}

    known.append(route(0, 300, [100, 150, 200]))
    put(tmp_path / "in", "b.txt", [message(4, 310)])
    ledger, step = smooth_all(spark, tmp_path, table)
    out = ledger.log("output")
    assert {(r["batch_id"], r["after_offset"], r["j"]) for r in out.collect()} >= {(0, 0, 0), (0, 1, 0), (2, 2, 0)}
    assert out.filter("j > 0").count() > 0 and out.filter("partition = 1").count() == 0
    assert ledger.state("retry", "value string").count() == 0
    entries = ledger.latest
    retry_waiting(ledger, step)
    assert ledger.latest == entries


def test_figures_come_with_the_write(spark, tmp_path):
    """Equal to the summary that reads everything again; a fix without a JSON form is output and not written."""
    put(tmp_path / "in", "a.txt", [message(0, 0), message(2, 300), message(4, 310, speed="NaN"), message(1, 0), message(3, 5, speed="x")])
    ledger, _ = smooth_all(spark, tmp_path, spark.createDataFrame([route(0, 300, [100, 150, 200])], ROUTE))
    out = ledger.log("output")
    again = batch_summary(
        ledger.log("batches").select("partition", "batch_id", F.col("first_offset").alias("offset"), F.lit(None).cast("string").alias("error")),
        out,
        encode_output(out),
    )
    totals = again.agg(F.sum("outputs"), F.sum("written")).first()
    assert tuple(ledger.log("figures").select("outputs", "written").first()) == tuple(totals)
    assert totals[0] > totals[1] > 0
    batches = ledger.log("batches").orderBy("partition").collect()
    assert [(r["partition"], r["messages"], r["errors"], r["batch_key"]) for r in batches] == [(0, 3, 0, "0:0"), (1, 2, 1, "1:0")]


def test_attempts_come_to_an_end(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [message(0, 0, speed="x"), message(2, 1)])
    ledger, step = smooth_all(spark, tmp_path, spark.createDataFrame([], ROUTE))
    retry_waiting(ledger, step)
    assert ledger.log("rejected").count() == 0
    retry_waiting(ledger, step)
    rejected = ledger.log("rejected").orderBy("offset").collect()
    assert [(r["offset"], r["attempts"], r["verdict"], r["error"] is None) for r in rejected] == [(0, 3, "reject", False), (1, 3, "reject", True)]
    assert ledger.state("retry", "value string").count() == 0 and ledger.log("output").count() == 0


def test_a_lost_checkpoint_writes_nothing_twice(spark, tmp_path):
    table = spark.createDataFrame([], ROUTE)
    put(tmp_path / "in", "a.txt", [message(0, 0), message(1, 10), message(2, 20)])
    ledger, _ = smooth_all(spark, tmp_path, table)
    before = rows_of(ledger.log("output").select("partition", "after_offset"))
    put(tmp_path / "in", "b.txt", [message(2, 20), message(4, 30)])
    ledger, _ = smooth_all(spark, tmp_path, table, checkpoint="another")
    after = rows_of(ledger.log("output").select("partition", "after_offset"))
    assert after == sorted([*before, (0, 2)])
    assert rows_of(ledger.state("offsets", "partition int, first bigint, last bigint")) == [(0, 0, 2), (1, 0, 0)]


# --- devices across micro-batches -------------------------------------------------------

SHOWN = ["device_id", "after_timestamp", "after_offset", "j", "latitude", "longitude", "speed"]


def fleet_points(spark):
    a = track_of(spark, [0, 30, 400, 410, 900, 905, 910], "a")
    b = track_of(spark, [0, 500, 510], "b").withColumn("offset", F.col("offset") + 100)
    c = track_of(spark, [50], "c").withColumn("offset", F.lit(200).cast("bigint"))
    return a.unionByName(b).unionByName(c)


def shown(df):
    return sorted((tuple(r[n] for n in SHOWN) for r in df.select(*SHOWN).collect()), key=repr)


def test_cuts_equal_the_batch(spark, tmp_path):
    points = fleet_points(spark)
    table = spark.createDataFrame([route(30, 400, [100, 200, 300]), route(410, 900, [500, 600, 700]), route(0, 500, [100, 300])], ROUTE)
    whole = shown(smooth(points, roads(spark), table, on_missing_route="keep_gap"))
    rows = sorted(points.collect(), key=lambda r: (r["timestamp"], r["device_id"]))
    schema = points.schema
    # early and late, within a second and between devices
    for cuts in ([1, 3, 6, 9], [2, 5, 8]):
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        ledger = Ledger(spark, str(tmp_path / f"ledger-{cuts[0]}"))
        step = device_step(ledger, roads(spark), table)
        for epoch, part in enumerate(parts):
            step(spark.createDataFrame(part, schema), epoch)
        step(spark.createDataFrame(part, schema), epoch)  # a replay adds nothing
        lone = lone_fixes(ledger).withColumns({"after_timestamp": F.col("timestamp"), "after_offset": F.col("offset"), "j": F.lit(0)})
        assert shown(ledger.log("output").select(*SHOWN).unionByName(lone.select(*SHOWN))) == whole
    assert set(FIX_COLUMNS) <= set(POINT.replace(",", "").split()[::2])


# --- counters ---------------------------------------------------------------------------


def test_counts_after_any_split(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("abc"), k) for k in range(95)]
    folder = tmp_path / "in"
    folder.mkdir()
    at = 0
    for k, size in enumerate([1, 30, 9, 40, 15]):
        (folder / f"{k}.txt").write_text("\n".join(f"{v},{o}" for v, o in rows[at : at + size]) + "\n", encoding="utf-8")
        os.utime(folder / f"{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
        at += size

    def run():
        ledger = Ledger(spark, str(tmp_path / "ledger"))
        lines = read_lines_stream(spark, str(folder), max_files=1)
        typed = lines.select(F.split("value", ",")[0].alias("veh_id"), F.split("value", ",")[1].cast("bigint").alias("offset"))
        start(typed, counting_step(ledger), str(tmp_path / "checkpoint"), ONCE).awaitTermination()
        return ledger

    ledger = run()
    batch = spark.createDataFrame(rows, "veh_id string, offset bigint")
    counts = rows_of(batch.groupBy("veh_id").count())
    assert rows_of(ledger.state("counts", "veh_id string, messages bigint")) == counts
    assert sum(n for _, n in rows_of(ledger.log("reports").groupBy("veh_id").count())) == sum(n // 10 for _, n in counts)
    # the files came one at a time, the oldest first
    assert ledger.latest == 4
    assert rows_of(ledger.log("reports").select("veh_id", "offset", "pos")) == rows_of(every_nth(batch).select("veh_id", "offset", "pos"))
    # a restart adds nothing
    assert run().latest == ledger.latest


def test_a_replayed_epoch_counts_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    step = counting_step(ledger)
    rows = spark.createDataFrame([("v", k) for k in range(25)], "veh_id string, offset bigint")
    step(rows, 0)
    step(rows, 0)
    assert rows_of(ledger.state("counts", "veh_id string, messages bigint")) == [("v", 25)]
    assert rows_of(ledger.log("reports").select("pos")) == [(10,), (20,)]
