from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from trackloom.llm import jaccard, languages, oracle, queries
from trackloom.llm.common import table


def test_stages_chain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == names
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] == counts[3]
    assert all(r["text"] is None or "@mail" not in r["text"] for r in docs.collect())


def test_stages_against_the_operators(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    known = corpus_pipeline.known_language(spark, docs, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"] for r in known.collect()} == {d for d, t in rows if t and any(c.isalpha() for c in t)}
    one = corpus_pipeline.one_of_each(spark, docs, sf_dir)
    groups = {r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in one.collect()} == groups


def test_run(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in pieces)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 4096 + offset == at
        at += length


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        connection.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.REGISTRY[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = connection.sql(oracle.SQL[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[p] for p in place) for r in want.fetchall())


def test_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names
    assert languages.UNKNOWN == "und"
