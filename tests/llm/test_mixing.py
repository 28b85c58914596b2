from __future__ import annotations

import re
from collections import defaultdict

import pytest

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm.mixing import mix, sample


def plain_targets(sizes):
    """Shares by weight; what is above its bound is cut and shared again until none is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        whole = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / whole > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / whole for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def check(rows, docs):
    size = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in docs]
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == sorted((d or -1, n) for d, _, n in size)
    sizes = defaultdict(int)
    for _, s, n in size:
        sizes[s] += n
    return sizes, plain_targets(sizes)


def test_targets_and_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    rows = sample(docs).collect()
    sizes, targets = check(rows, raw)
    source = {d: s for d, _, s in raw}
    taken = defaultdict(int)
    longest = max(r["size"] for r in rows)
    for r in rows:
        assert r["source_size"] == sizes[source[r["doc_id"]]] and r["target"] == pytest.approx(targets[source[r["doc_id"]]])
        assert 0 <= r["copies"] <= 2
        taken[source[r["doc_id"]]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - targets[s]) <= longest for s in targets)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert same_rows(sample(docs), sample(docs.repartition(7)))


def test_awkward_rows(spark):
    raw = [(r[0], r[1], r[3]) for r in awkward_rows()]
    rows = sample(awkward(spark)).collect()
    _, targets = check(rows, raw)
    assert {round(r["target"], 6) for r in rows} == {round(t, 6) for t in targets.values()}
    assert sample(empty(spark)).count() == 0
    assert same_rows(sample(clashing(awkward(spark))), sample(awkward(spark)))
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r["copies"] for r in sample(nothing).collect()] == [0, 0]


def test_mix_repeats_rows(spark):
    df = clashing(awkward(spark))
    mixed = mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in sample(df).collect())


def test_native(spark):
    plan = sample(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
