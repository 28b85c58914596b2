"""Tables that a stream commits together.

An entry holds, for each table of the ledger, the rows that were written with it. It counts once its
mark is there, a file of one row that is written last: before that, nothing of the entry is read, and the next
attempt writes over it. So output, offsets and whatever a stream remembers move on together or
not at all, and a stream that lost its checkpoint goes on from the ledger.

A table is either a log, of which all entries count, or a state, of which the latest does. One stream
writes a ledger at a time. Folders of states older than the latest entry may be deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTRY = "entry"
_MARK = "entry bigint, writer string, epoch bigint"


class Ledger:
    """Tables in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        # The latest epoch of each writer, as far as committed, and the latest entry.
        marks = self._marks()
        latest = marks.agg(F.max("entry").alias("entry")).first() if marks is not None else None
        self.latest = -1 if latest is None or latest["entry"] is None else latest["entry"]
        epochs = marks.groupBy("writer").agg(F.max("epoch").alias("epoch")).collect() if marks is not None else []
        self.epochs: dict[str, int] = {r["writer"]: r["epoch"] for r in epochs}

    def _marks(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MARK).parquet(f"{self.path}/marks/*")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def writer(self) -> str:
        """Who writes: the query of the stream whose micro-batch this is. A new checkpoint folder makes a new query."""
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"

    def holds(self, epoch: int) -> bool:
        """Whether this epoch of the writer, or a later one, has been committed: a replay has nothing to do."""
        return self.epochs.get(self.writer(), -1) >= epoch

    def commit(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], epoch: int | None) -> int:
        """Write all tables as the next entry, in order, then its mark. Without an epoch no later one counts as a replay.

        A table may be given as a function, which is called once the tables before it are written.
        """
        entry, writer = self.latest + 1, self.writer()
        for name, table in tables.items():
            rows = table() if callable(table) else table
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{ENTRY}={entry}")
        reached = self.epochs.get(writer, -1) if epoch is None else epoch
        mark = self.spark.createDataFrame([(entry, writer, reached)], _MARK).coalesce(1)
        mark.write.mode("overwrite").parquet(f"{self.path}/marks/{entry}")
        self.latest, self.epochs[writer] = entry, reached
        return entry

    def state(self, name: str, schema: str | StructType) -> DataFrame:
        """Rows of the latest entry; none before the first."""
        if self.latest < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/{ENTRY}={self.latest}")

    def log(self, name: str) -> DataFrame:
        """Rows of all committed entries, with their ``entry``."""
        rows = self.spark.read.parquet(f"{self.path}/{name}").withColumn(ENTRY, F.col(ENTRY).cast("bigint"))
        return rows.filter(F.col(ENTRY) <= self.latest)
