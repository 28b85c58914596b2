"""A training-data pipeline over `documents`: language, near duplicates, personal data, mixture, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that the stage before kept. All but the last
return the columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.llm import jaccard, languages, mixing, packing, pii
from trackloom.llm.common import settle, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Those without a letter are rejected."""
    return languages.keep_identified(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 0.8 or more in common."""
    return jaccard.keep_one(docs, width=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced, and terms that disclose it."""
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, each with its source's share: their ids, and the digest of these."""
    return packing.sequences(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("personal_data", without_personal_data),
    ("mixture", mixed),
    ("packing", packed),
]

#: Rank-order profiles and tokens of a vocabulary file are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
