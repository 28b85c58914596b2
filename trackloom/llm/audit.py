"""Interaction of filters, audited with contingency tensors.

Five filters A to E are applied left to right in every order. How a document fares depends only on which filters it fails, so the
documents of a part are counted once, by that pattern: 2 x 2 x 2 x 2 x 2 numbers, an axis a filter, index 0 for pass and 1
for fail. Each figure of each step of each order is a contraction of that tensor: along every axis a vector selects pass,
fail or both, and one einsum sums what is selected, for all orders and steps together.

E fails where a smaller id holds the same text. Texts are compared by their SHA-256. Rows of one text are counted by
(text, part, pattern, labels), with the least id and how often it occurs there, and these counts meet by text: copies collapse before
they are exchanged, and no join brings rows to a text.

Cases: a null text is the empty text (fails A). A null part is the empty string. A null id is smaller than any other, and rows that
share an id are not copies of each other. A document counts as good or toxic if any of its labels says so; labels of unknown ids
count nowhere. An empty table has no parts and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackloom.llm.common import as_bytes, batch, importable, map_batches
from trackloom.llm.ordering import id_key

FILTERS = "ABCDE"
#: A: fewer words. B: distinct words, in hundredths of all, below. C: upper case, in hundredths of all characters, above.
FEWEST_WORDS, DISTINCT, UPPER = 100, 80, 10
MARKS = b"#$%&*|"

CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes of UTF-8 that begin no code point.
CONTINUED = bytes(range(0x80, 0xC0))
PASS, FAIL, ANY = (1, 0), (0, 1), (1, 1)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
RESULT = "part string, filter_order string, step int, filter string, " + ", ".join(
    f"{n} long" for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
)


def failing(text: bytes) -> int:
    """The filters A to D that a text fails: A is bit 0."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        len(words) < FEWEST_WORDS,
        100 * len(set(words)) < DISTINCT * len(words),
        100 * capitals > UPPER * len(text.translate(None, CONTINUED)),
        len(text.translate(None, MARKS)) < len(text),
    )
    return sum(f << k for k, f in enumerate(fails))


def judged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(key, digest, part, mask) of every row: the id, null as the least, and what the text alone decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b.column(2))
            yield batch(
                {
                    "key": (b.column(0).to_pylist(), pa.int64()),
                    "part": (b.column(1).to_pylist(), pa.string()),
                    "digest": ([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    "mask": ([failing(t) for t in texts], pa.int32()),
                }
            )

    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(id_key(id_col).alias("key"), part.alias("part"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "key long, part string, digest binary, mask int")


def patterns(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail, with those labelled good and toxic."""

    def marked(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0))

    known = labels.groupBy(F.col(id_col).cast("long").alias("key")).agg(marked("quality").alias("good"), marked("toxic").alias("toxic"))
    rows = judged(docs, id_col, text_col, part_col).groupBy("key", "digest", "part", "mask").agg(F.count("*").alias("n"))
    # rows without an id have no label: they are spread by text, not sent to one task
    spread = F.when(F.col("key") == F.lit(-(2**63)), F.col("digest")).otherwise(F.lit(b""))
    labelled = rows.withColumn("spread", spread).join(known.withColumn("spread", F.lit(b"")), ["key", "spread"], "left")
    of_text = ["digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")]
    texts = labelled.groupBy(*of_text).agg(F.sum("n").alias("n"), F.min("key").alias("least"), F.min_by("n", "key").alias("at_least"))
    # a text has one pattern, so it has a few rows a part at most
    first = F.min("least").over(Window.partitionBy("digest"))
    own = texts.withColumn("own", F.when(F.col("least") == first, F.col("at_least")).otherwise(0))
    copies = F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("own")).alias("n"))
    both = own.withColumn("case", F.explode(F.array(F.struct("mask", F.col("own").alias("n")), copies)))
    sums = [F.sum(F.col("case.n") * w).alias(name) for name, w in (("n", F.lit(1)), ("good", F.col("good")), ("toxic", F.col("toxic")))]
    return both.groupBy("part", F.col("case.mask").alias("mask")).agg(*sums)


def selectors(choose) -> np.ndarray:
    """For every order and step, the vector along each axis: choose(place of the axis' filter in the order, step)."""
    return np.array([[choose(order.index(f), step) for f in FILTERS] for order in ORDERS for step in range(len(FILTERS))], dtype=np.int64)


#: Selected along an axis, by the place of its filter before, at or after the step.
KEPT = selectors(lambda place, step: PASS if place <= step else ANY)
REMOVED = selectors(lambda place, step: FAIL if place == step else PASS if place < step else ANY)
FAILED = selectors(lambda place, step: FAIL if place == step else ANY)
ALONE = selectors(lambda place, step: FAIL if place == step else PASS)


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return np.einsum("abcde,na,nb,nc,nd,ne->n", tensor, *(chosen[:, axis] for axis in range(len(FILTERS))))


def figures(mask: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """All figures of a part, by order and step, from its patterns."""
    tensors = []
    for counts in (n, good, toxic):
        flat = np.zeros(1 << len(FILTERS), dtype=np.int64)
        np.add.at(flat, mask, counts)
        # the highest bit of a flat index is the first axis of its shape: turned round, so that axis 0 is A
        tensors.append(flat.reshape((2,) * len(FILTERS)).transpose())
    removed = contract(tensors[0], REMOVED)
    letter = np.array([FILTERS.index(order[step]) for order in ORDERS for step in range(len(FILTERS))])
    of_filter = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(of_filter, letter, removed)
    return {
        "kept": contract(tensors[0], KEPT),
        "removed": removed,
        "redundant": contract(tensors[0], FAILED) - removed,
        "unique_fails": contract(tensors[0], ALONE),
        "good_lost": contract(tensors[1], REMOVED),
        "toxic_lost": contract(tensors[2], REMOVED),
        "shapley": of_filter[letter],
    }


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order and step: (part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    A part reaches its task as at most 32 rows of counts.
    """
    importable(docs.sparkSession)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = figures(*(rows.column(c).to_numpy() for c in ("mask", "n", "good", "toxic")))
        places = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
        columns = {
            "part": pa.array([key[0].as_py()] * len(places), pa.string()),
            "filter_order": pa.array([order for order, _ in places], pa.string()),
            "step": pa.array([step + 1 for _, step in places], pa.int32()),
            "filter": pa.array([order[step] for order, step in places], pa.string()),
        }
        return pa.table(columns | {name: pa.array(values, pa.int64()) for name, values in found.items()})

    return patterns(docs, labels, id_col, text_col, part_col).groupBy("part").applyInArrow(run, RESULT)
