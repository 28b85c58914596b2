from __future__ import annotations

import random

import pytest

from trackloom.operators import offsets

MESSAGE = "partition int, offset bigint, error string"


def messages(spark, rows):
    return spark.createDataFrame(rows, MESSAGE)


@pytest.mark.parametrize("width", [1, 3, 100_000])
def test_batches_with_holes(spark, width):
    rng = random.Random(5)
    rows = [(0, o, None) for o in sorted(rng.sample(range(200), 47))] + [(1, 5, None), (1, 6, None)]
    expected = {(0, o): k // 10 for k, (_, o, _) in enumerate(rows[:47])} | {(1, 5): 0, (1, 6): 0}
    rng.shuffle(rows)
    got = offsets.assign_batches(messages(spark, rows), 10, width).collect()
    assert {(r["partition"], r["offset"]): r["batch_id"] for r in got} == expected


def stored(spark, rows):
    return spark.createDataFrame(rows, "partition int, offset bigint")


def test_start_from(spark):
    rows = messages(spark, [(0, 0, None), (0, 5, None), (1, 0, None)])
    got = offsets.start_from(rows, stored(spark, [(0, 5)])).collect()
    assert sorted((r["partition"], r["offset"]) for r in got) == [(0, 5), (1, 0)]


def test_building_a_plan_runs_no_job(spark):
    """No job is started before the rows are asked for."""
    rows = messages(spark, [(0, 0, None), (0, 5, None)])
    done = stored(spark, [(0, 5)])
    spark.sparkContext.setJobGroup("planning", "none")
    try:
        offsets.start_from(rows, done)
        offsets.skip_processed(offsets.assign_batches(rows, 2), done)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_skip_processed(spark):
    rows = offsets.assign_batches(messages(spark, [(p, o, None) for p in (0, 1) for o in range(4)]), 2)
    got = offsets.skip_processed(rows, stored(spark, [(0, 1)])).collect()
    assert sorted((r["partition"], r["offset"]) for r in got) == [(0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3)]
    # A batch that starts at or below the stored offset is left out as a whole.
    got = offsets.skip_processed(rows, stored(spark, [(0, 0), (1, 2)])).collect()
    assert sorted((r["partition"], r["offset"]) for r in got) == [(0, 2), (0, 3)]


def test_duplicates(spark):
    rows = messages(spark, [(0, 1, None)] * 50 + [(0, 2, None), (1, 1, None)])
    got = offsets.drop_inflight_duplicates(rows).collect()
    assert sorted((r["partition"], r["offset"]) for r in got) == [(0, 1), (0, 2), (1, 1)]


def test_last_write_wins(spark):
    commits = spark.createDataFrame([(0, 9, 1), (0, 4, 2), (1, 3, 1)], "partition int, offset bigint, commit_seq bigint")
    assert {tuple(r) for r in offsets.last_offsets(commits).collect()} == {(0, 4), (1, 3)}


def test_summary_and_errors(spark):
    rows = messages(spark, [(0, 0, None), (0, 1, "OSRM down"), (0, 2, "OSRM gone"), (0, 3, "bad"), (1, 7, None)])
    batches = offsets.assign_batches(rows, 3)
    summary = {
        (r["partition"], r["batch_id"]): tuple(r)[2:]
        for r in offsets.batch_summary(batches, batches.filter("partition = 1")).collect()
    }
    assert summary == {
        (0, 0): (3, 0, 2, 2, 0, "0:0"),
        (0, 1): (1, 3, 3, 1, 0, "0:3"),
        (1, 0): (1, 7, 7, 0, 1, "1:7"),
    }
    match = {(r["partition"], r["batch_id"]): r["all_match"] for r in offsets.all_errors_match(batches, "OSRM").collect()}
    assert match == {(0, 0): True, (0, 1): False}
