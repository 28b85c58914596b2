"""Every registered query against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from trackloom.operators.snap import snap_to_road
from trackloom.plans import catalog, inputs, oracle

QUERIES = catalog.REGISTRY
SQL = oracle.oracle_sql()
# Operators that a single machine's plan must never contain.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{sf_dir}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in FORBIDDEN if operator in plan]
    columns = sorted(df.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == columns
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    place = [expected.columns.index(c) for c in columns]
    want = sorted(repr(tuple(plain(r[p]) for p in place)) for r in expected.fetchall())
    assert got == want


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["device_id", "segments", "gaps", "path_m"]
    assert df.count() > 0


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    plan = QUERIES["gap_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: (\S+)", plan))
    assert schemas and not any("props" in s or "event_type" in s for s in schemas)


def test_snap_broadcasts_nothing_beyond_the_threshold(spark, sf_dir):
    """Without the size-checked automatic broadcast every join of the road search is an equi-join by exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = snap_to_road(inputs.derive(spark, sf_dir, "SCATTERED"), inputs.derive(spark, sf_dir, "ROADS"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
        assert "SortMergeJoin" in plan
        assert df.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
