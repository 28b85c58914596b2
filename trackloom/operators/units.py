"""Setting whole units aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def split_by_units(rows: DataFrame, listed: DataFrame, unit: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of units that are not in ``listed``, and rows of units that are.

    ``listed`` holds each unit once. A small list is sent to the rows; beyond Spark's size
    threshold both sides are exchanged, and a unit with a large share of all rows is split by
    the skew join.
    """
    keys = list(unit)
    return rows.join(listed, keys, "left_anti"), rows.join(listed, keys, "left_semi")
