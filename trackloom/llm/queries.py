"""The registered queries of this package: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.llm import alignment, audit, fingerprints, jaccard, languages, licenses, mixing, packing, pii, repeats, search, sharding, simhash
from trackloom.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edited(table(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op4_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"))
    # of the texts as they stand in their shards
    text = F.coalesce("row.text", F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("row.doc_id", size, crc, law, "shard", "slot", grown)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.sample(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85).drop("stays")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


REGISTRY = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_repeats, op3_licenses, op4_languages, op5_packing, op6_sharding, op7_mixing, op8_pii, op9_search, op10_jaccard,
        op11_simhash, op12_filter_audit, op13_alignment,
    )
}
