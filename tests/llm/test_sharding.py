from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm.sharding import shard_by_bytes, shard_rows


def check(rows, docs, shards=8):
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in docs)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [sizes[k] for k in range(shards)]


def test_sizes_are_near_equal(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    sizes = check(shard_by_bytes(docs).collect(), texts)
    largest = max(len(t.encode()) for t in texts)
    assert max(sizes) - min(sizes) <= 2 * largest


def test_a_group_of_copies_is_split_only_as_needed(spark):
    copies = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))
    others = spark.range(1000, 2800).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    rows = shard_by_bytes(copies.union(others)).collect()
    sizes = check(rows, ["one text for all"] * 900 + [f"text number {k}" for k in range(1000, 2800)])
    assert max(sizes) - min(sizes) <= 40
    pairs = shard_by_bytes(others.union(others.withColumn("doc_id", F.col("doc_id") + 10_000)), tolerance=0.02).collect()
    by_text = defaultdict(set)
    for r in pairs:
        by_text[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_edges(spark):
    check(shard_by_bytes(awkward(spark)).collect(), [r[1] for r in awkward_rows()])
    assert shard_by_bytes(empty(spark)).count() == 0
    same = spark.createDataFrame([(1, "a")] * 40, "doc_id long, text string")
    assert check(shard_by_bytes(same).collect(), ["a"] * 40)
    keyed = ["doc_id", "size", "shard"]
    assert same_rows(shard_by_bytes(clashing(awkward(spark))).select(keyed), shard_by_bytes(awkward(spark)).select(keyed))


def test_native(spark):
    plan = shard_by_bytes(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_rows_stand_in_their_shards(spark):
    """The same places as by numbers alone, with every column of the rows."""
    df = clashing(awkward(spark))
    rows = shard_rows(df)
    assert rows.schema["row"].dataType.names == df.columns
    where = rows.select("row.doc_id", "shard", F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_crc32"))
    assert same_rows(where, shard_by_bytes(df).select("doc_id", "shard", "text_crc32"))
    assert same_rows(rows.select("row.*"), df)
    check(rows.select("shard", "slot", (F.octet_length(F.coalesce("row.text", F.lit(""))) + 1).alias("size"), F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_crc32")).collect(), [r[1] for r in awkward_rows()])
    assert shard_rows(empty(spark)).count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
