"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in links (a, b): the label is the smallest node that can be reached.

    Each round takes the least label among neighbours and then the label's own label, so paths shrink by half;
    the labels are settled between rounds, and the driver sees a count only.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = settle(edges, "edges")
    labels = settle(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("at")).agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("at")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = settle(lower, "labels")
        own = lower.select(F.col("node").alias("of"), F.col("label").alias("next"))
        jumped = lower.join(own, F.col("label") == F.col("of")).select("node", "old", F.least("label", "next").alias("label"))
        jumped = settle(jumped, "labels")
        if jumped.where("label < old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
