"""Language identification by rank-order profiles.

A profile lists a language's most frequent n-grams (1 to 3 bytes of the lower-case text, words padded by one blank) in
descending frequency. A document's own list is compared with each profile by the out-of-place distance: the sum over its
n-grams of how far their ranks lie apart, an absent n-gram counting the whole profile length. The nearest profile wins.

Training reads labelled rows only: for each language those with the smallest hash of id, at most `per_language`; of rows with
one id it reads one. With no bound the sample would be the whole table; the ranks of the leading few hundred n-grams settle long before.

Cases: a null text or one without a letter is `und` with score 0. Ties go to the language that is first by code point.
With no labelled row every text is `und`. Documents with null language are never learnt from but predicted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from trackloom.llm.common import as_bytes, batch, importable, map_batches, settle

PROFILE = 400
PER_LANGUAGE = 2000
UNKNOWN = "und"
#: Bins that hashes of ids are counted in, as bits.
BIN_BITS = 12
#: A document with a lower score is rejected by `keep_identified`. The score is 0 where no n-gram is in the nearest profile and 1
#: where all have its rank; prose of a learned language, and text made like it, lies above 0.4.
LEAST_SCORE = 0.1

#: ASCII other than letters to blanks; bytes of other characters stay.
LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def grams(text: bytes) -> np.ndarray:
    """Every 1-, 2- and 3-gram of the words as one number, blanks only next to letters."""
    folded = b" ".join(text.decode(errors="replace").lower().encode().translate(LETTERS).split())
    if not folded:
        return np.zeros(0, dtype=np.uint32)
    x = np.frombuffer(b" " + folded + b" ", dtype=np.uint8).astype(np.uint32)
    two = x[:-1] << 8 | x[1:]
    three = two[:-1] << 8 | x[2:]
    inner = x[1:-1]
    return np.concatenate([inner[inner != 32], two, three[(three >> 8 & 255) != 32]])


def ranking(keys: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The most frequent keys, most frequent first, ties by key."""
    if len(keys) > length:
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))][:length]


def counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    edges = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, dtype=np.int64)
    return x[edges], np.diff(np.append(edges, len(x)))


class Classifier:
    """The profiles of all languages, side by side."""

    def __init__(self, profiles: dict[str, list[int]], length: int = PROFILE):
        self.length, self.languages = length, sorted(profiles)
        self.keys = np.array(sorted({k for p in profiles.values() for k in p}), dtype=np.uint32)
        self.ranks = np.full((len(self.languages), len(self.keys) + 1), -1, dtype=np.int64)
        for row, language in enumerate(self.languages):
            self.ranks[row, np.searchsorted(self.keys, np.array(profiles[language], dtype=np.uint32))] = np.arange(len(profiles[language]))

    def predict(self, text: bytes) -> tuple[str, float]:
        """Language and score: the share of the greatest distance by which the nearest profile falls short of it."""
        own = ranking(*counted(grams(text)), self.length)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, own)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != own] = len(self.keys)
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.length, np.abs(ranks - np.arange(len(own))))
        distances = apart.sum(axis=1)
        best = int(distances.argmin())
        return self.languages[best], float(round(1.0 - distances[best] / (self.length * len(own)), 6))


def training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of the labelled rows with the smallest hash of id in each language, one row of each hash.

    Hashes are counted in bins; only those up to the bin where a language's limit falls are ranked, the limit and some 1 / 4096 of
    the language. So no task ranks a language, and rows that share an id or a hash do not add to the sample.
    """
    labelled = docs.where("lang is not null and text is not null").withColumn("h", F.xxhash64("id"))
    hashes = labelled.select("lang", "h").distinct().withColumn("bin", F.shiftright("h", 64 - BIN_BITS))
    reached = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    bins = hashes.groupBy("lang", "bin").agg(F.count("*").alias("n")).withColumn("reached", reached)
    last = F.coalesce(F.min(F.when(F.col("reached") >= per_language, F.col("bin"))), F.max("bin"))
    # settled, as the limits below, so that its size is known: one row per language is sent to the rows, which are not exchanged
    edges = settle(bins.groupBy(F.col("lang").alias("of")).agg(last.alias("edge")), "language-edges")
    near = hashes.join(edges, (F.col("lang") == F.col("of")) & (F.col("bin") <= F.col("edge"))).select("lang", "h")
    chosen = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= per_language)
    limits = chosen.groupBy(F.col("lang").alias("of")).agg(F.max("h").alias("limit"))
    limits = settle(limits, "language-limits")
    sample = labelled.join(limits, (F.col("lang") == F.col("of")) & (F.col("h") <= F.col("limit")))
    return sample.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def learn(docs: DataFrame, length: int = PROFILE, per_language: int = PER_LANGUAGE) -> dict[str, list[int]]:
    """Profiles from rows (id, text, lang). The driver gets `length` numbers per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, int]] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                mine = sums.setdefault(lang, {})
                for key, n in zip(*(a.tolist() for a in counted(grams(text))), strict=True):
                    mine[key] = mine.get(key, 0) + n
        for lang, mine in sums.items():
            yield batch({"lang": ([lang] * len(mine), pa.string()), "gram": (list(mine), pa.int64()), "n": (list(mine.values()), pa.int64())})

    counts = map_batches(training_rows(docs, per_language), run, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= length)
    profiles: dict[str, list[int]] = {}
    for row in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def predict(docs: DataFrame, profiles: dict[str, list[int]], length: int = PROFILE) -> DataFrame:
    """Rows (id, text) with lang_pred and score instead of the text. No exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(profiles, length)
        for b in batches:
            letters = b.column(2).to_pylist()
            found = [model.predict(t) if ok else (UNKNOWN, 0.0) for t, ok in zip(as_bytes(b.column(1)), letters, strict=True)]
            yield batch({"id": (b.column(0).to_pylist(), pa.int64()), "lang_pred": ([f[0] for f in found], pa.string()), "score": ([f[1] for f in found], pa.float64())})

    rows = docs.select("id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return map_batches(rows, run, "id long, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """Predicts every row; learns only from rows whose crc32(id as text) mod folds is not 0."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    profiles = learn(rows.where(~held))
    found = predict(rows, profiles)
    return found.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least_score: float = LEAST_SCORE) -> DataFrame:
    """docs whose text is in one of the learned languages: what is `und`, or farther than `least_score` from every profile, goes.

    Without a labelled row nothing is learnt and nothing rejected. The columns stay as they are, in order; all of them ride along through the prediction, which needs no exchange.
    """
    rows = docs.select(F.xxhash64(F.col(text_col)).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    profiles = learn(rows)
    if not profiles:
        return docs
    importable(docs.sparkSession)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series, letters: pd.Series) -> pd.Series:
        model = Classifier(profiles)
        return pd.Series([bool(ok) and model.predict((t or "").encode())[1] >= least_score for t, ok in zip(texts, letters, strict=True)])

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.where(known(F.col(text_col), letters))
