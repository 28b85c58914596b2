"""Exact top-k by inner product over an impact-ordered index, a score at a time.

Each block of vectors is an index with a posting list per dimension, ordered by the size of the component. A query turns a
list into impacts, component times query component, and the segments of all lists are processed by descending level of impact,
quantised to powers of two of the highest, into one accumulator per vector. What is left of a vector lies between plus and
minus the level in each list where it has not been met. A block is left as soon as that proves that all but a few vectors
stay below the k-th best accumulator; those few are rescored exactly. Nothing is skipped without the proof, so the answer
is exact whatever the data.

Queries and vectors are dealt to blocks of bounded size and each pair of blocks meets in one task, which builds the index of its
vectors once for all its queries; the k best of each meet by query. A vector is sent once for each 4096 queries, a query
once for each 16,384 vectors: with a query for every hundredth row both sides send much the same.

Cases: vectors that are null or hold null or non-finite components take no part, as query or candidate. Vectors of
unequal length are compared as if filled up with zeros. Ties go to the smaller id; rows that repeat an id are candidates each,
and rows with a query's own id are not its candidates. Scores beyond 64 bits are cut to the range of a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackloom.llm.common import importable, settle

SCALE = 1024
TOP = 10
EVERY = 100
VECTORS_IN_BLOCK = 16384
QUERIES_IN_BLOCK = 4096
#: The level of impacts is halved so many times at most; what may be a member then is rescored.
STEPS = 12
#: A block is left when at most this share of its vectors, or this number, can still be members.
FEW, FEWEST = 0.25, 64
#: Room for the rounding of accumulators.
SLACK = 1e-9
EXACT = 2**53


def usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def quantised(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors)


class Index:
    """Posting lists of one block: for every dimension the rows by falling size of the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        order = np.argsort(-np.abs(vectors), axis=0, kind="stable")
        self.rows = np.ascontiguousarray(order.T)
        self.values = np.ascontiguousarray(np.take_along_axis(vectors, order, axis=0).T)
        self.sizes = -np.abs(self.values)

    def members(self, query: np.ndarray, top: int) -> np.ndarray:
        """Rows that may be among the best, with proof for all others.

        After the segments of impact `level` and above, a list in which a row has not been met adds less than
        the level, or than the list's highest impact, to either side of its accumulator.
        """
        n, strength = len(self.ids), np.abs(query)
        highest = strength * -self.sizes[:, 0] if n else strength
        level = float(highest.max(initial=0)) / 2
        if n <= max(FEWEST, top) or level <= 0:
            return np.arange(n)
        done, met, taken = np.zeros(n), np.zeros(n), np.zeros(len(query), dtype=np.int64)
        for _ in range(STEPS):
            for d in np.flatnonzero(highest >= level):
                count = int(np.searchsorted(self.sizes[d], -level / strength[d], side="right"))
                part = slice(taken[d], count)
                rows = self.rows[d, part]
                done[rows] += self.values[d, part] * query[d]
                met[rows] += 1
                taken[d] = count
            rest = np.minimum(level, highest).sum() - level * met
            bar = np.partition(done - rest, n - top)[n - top]
            possible = np.flatnonzero(done + rest >= bar - SLACK * max(1.0, abs(bar)))
            if len(possible) <= max(FEWEST, FEW * n):
                return possible
            level /= 2
        return possible

    def best(self, own: int, query: np.ndarray, top: int) -> list[tuple[int, int]]:
        """(score, id) of the best, without rows of the query's own id. One place more covers the query itself."""
        extra = int((self.ids == own).sum())
        rows = self.members(query, top + extra)
        rows = rows[self.ids[rows] != own]
        if np.abs(query).max(initial=0) * np.abs(self.vectors[rows]).max(initial=0) * max(1, len(query)) < EXACT:
            scores = (self.vectors[rows] @ query).astype(np.int64)
        else:
            whole = [sum(int(a) * int(b) for a, b in zip(v, query, strict=True)) for v in self.vectors[rows]]
            scores = np.array([max(-(2**63), min(2**63 - 1, s)) for s in whole], dtype=np.int64)
        order = np.lexsort((self.ids[rows], ~scores))[:top]
        return [(int(scores[k]), int(self.ids[rows[k]])) for k in order]


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), dims))
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return quantised(out)


def search_block(key: tuple, queries: pa.Table, vectors: pa.Table, top: int) -> pa.Table:
    out = []
    if queries.num_rows and vectors.num_rows:
        dims = max(max(len(v) for v in t.column("vector").to_pylist()) for t in (queries, vectors))
        index = Index(vectors.column("id").to_numpy(), matrix(vectors.column("vector"), dims))
        for own, query in zip(queries.column("id").to_pylist(), matrix(queries.column("vector"), dims), strict=True):
            out.extend((own, vec, score) for score, vec in index.best(own, query, top))
    columns = list(zip(*out, strict=True)) if out else [[], [], []]
    return pa.table({name: pa.array(list(c), pa.int64()) for name, c in zip(["query_id", "vec_id", "score"], columns, strict=True)})


def top_k(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, every: int = EVERY
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best candidates of each row whose id is divisible by `every`."""
    spark = embeddings.sparkSession
    importable(spark)
    vector = F.col(vector_col).cast("array<double>")
    rows = embeddings.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    rows = settle(rows.where(usable(F.col("vector"))), "vectors")
    queries = rows.where(F.col("id") % every == 0)
    vector_blocks = 1 + rows.count() // VECTORS_IN_BLOCK
    query_blocks = 1 + queries.count() // QUERIES_IN_BLOCK

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(own_blocks))
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_blocks - 1).cast("long"))))

    left = dealt(queries, "q", query_blocks, "v", vector_blocks).groupBy("q", "v")
    right = dealt(rows, "v", vector_blocks, "q", query_blocks).groupBy("q", "v")

    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        return search_block(key, a, b, top)

    found = left.cogroup(right).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
