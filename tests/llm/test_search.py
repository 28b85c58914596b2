from __future__ import annotations

import math
import random

import numpy as np
import pytest

from trackloom.llm.search import Index, top_k

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, top=10, every=100):
    good = [(k, [math.floor(1024 * float(x)) for x in v]) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), k) for k, b in good if k != q)
            out += [(q, rank, k, -s) for rank, (s, k) in enumerate(scored[:top], 1)]
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in top_k(df, **options).collect())


def vectors(n, dims=12, seed=1, copies=0):
    rng = random.Random(seed)
    rows = [(k, [float(np.float32(rng.gauss(0, 1))) for _ in range(dims)]) for k in range(n)]
    return rows + [(n + k, rows[3][1]) for k in range(copies)]


@pytest.mark.parametrize(("n", "dims", "copies"), [(5, 3, 0), (700, 12, 60), (300, 64, 0)])
def test_against_all_pairs(spark, n, dims, copies):
    rows = vectors(n, dims, copies=copies)
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_edges(spark):
    rows = vectors(210, 4) + [(300, None), (400, [1.0, None, 0.0, 0.0]), (500, [float("nan")] * 4), (600, [float("inf")] * 4), (None, [1.0] * 4), (700, []), (800, [1.0]), (900, [0.0] * 4)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(100, [1.0, 2.0])], SCHEMA)) == []
    twice = [(100, [1.0, 0.5]), (100, [1.0, 0.5]), (7, [2.0, 1.0]), (7, [2.0, 1.0])]
    assert len(got(spark.createDataFrame(twice, SCHEMA))) > 0
    large = [(0, [1e15, 1e15]), (1, [1e15, 1.0]), (2, [-1e15, 5.0])]
    assert [r[2] for r in got(spark.createDataFrame(large, "vec_id long, embedding array<double>"))] == [1, 2]


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert got(df) == plain([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_members_are_never_lost():
    rng = np.random.default_rng(2)
    for spread in (1.0, 3.0):
        values = np.floor(1024 * rng.standard_normal((2000, 16)) ** (1 if spread == 1.0 else 3))
        index = Index(np.arange(2000), values)
        for k in range(0, 2000, 100):
            best = np.argsort(-(values @ values[k]), kind="stable")[:11]
            assert set(best) <= set(index.members(values[k], 11).tolist())
            assert len(index.members(values[k], 11)) < 2000
