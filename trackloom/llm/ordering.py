"""Neighbours in the order of an id, with one exchange of the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import importable, partitions

LEAST = -(2**63)


def id_key(name: str):
    """The id as a whole number that sorts like it: null first."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LEAST))


def ordered_blocks(df: DataFrame, id_col: str) -> DataFrame:
    """Deals the rows by ranges of the id, one range a partition, sorted within.

    Columns added: `key` (the id, null lowest) and `guest`. The first row of each range is also sent,
    as a guest behind all own rows, to the range before it; that of the first range to the last. So each own
    row finds its successor in its own partition. The driver sees one number per partition.
    """
    spark = df.sparkSession
    importable(spark)
    n = partitions(spark)
    ids = df.select(id_key(id_col).alias("key")).repartitionByRange(n, "key")
    firsts = ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key")).select("key").distinct()
    starts = np.array(sorted(r["key"] for r in firsts.collect()) or [LEAST], dtype=np.int64)
    count = len(starts)

    @F.pandas_udf("struct<block int, first boolean>")
    def place(keys: pd.Series) -> pd.DataFrame:
        block = np.maximum(np.searchsorted(starts, keys.to_numpy(), side="right") - 1, 0)
        return pd.DataFrame({"block": block.astype("int32"), "first": starts[block] == keys.to_numpy()})

    placed = df.withColumn("key", id_key(id_col)).withColumn("at", place("key"))
    own = F.struct(F.col("at.block").alias("block"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("at.block") - 1, F.lit(count)).alias("block"), F.lit(True).alias("guest"))
    dealt = placed.withColumn("to", F.explode(F.when(F.col("at.first"), F.array(own, before)).otherwise(F.array(own))))
    dealt = dealt.select(*df.columns, "key", F.col("to.guest").alias("guest"), F.col("to.block").alias("to_block"))
    return dealt.repartitionById(n, F.col("to_block")).drop("to_block")
