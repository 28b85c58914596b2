"""Small tables with every awkward row, and what the tests share."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ["id", "key", "block", "size", "chunk", "shard", "slot", "row", "spans", "n", "h", "guest", "start", "ids", "source_size", "keep_0", "k0"]
LONG = "word " * 20_000
WORDS = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "la", "de", "the"]


def awkward_rows() -> list[tuple]:
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, None, 3),
        (4, LONG, "en", "b", len(LONG)),
        (5, "same text, twice", "en", "b", 16),
        (6, "same text, twice", "fr", "c", 16),
        (6, "same text, twice", "fr", "c", 16),
        (7, "x", None, "a", 1),
        (8, "123 456", "en", "a", 7),
        (9, "naïve “quotes” 😀 日本", "fr", "c", 20),
        (None, "no id here", "en", "a", 10),
        (10, "nul\x00 \x1c\x85  end", "en", "é", 10),
    ]
    rng = random.Random(3)
    for k in range(11, 60):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 5, 40, 200])))
        rows.append((k, text, rng.choice(["en", "fr", "de", None]), rng.choice(["a", "b", "c", None]), len(text)))
    return rows


def awkward(spark, parts: int = 3):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(parts)


def clashing(df):
    """df with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("other").alias(name) for name in CLASHING])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same_rows(a, b) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
