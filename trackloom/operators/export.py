"""Exported text lines ``key:json`` to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.functions import empty_if_null, iso_timestamp
from trackloom.operators.decode import is_one_object
from trackloom.operators.rows import keep_rows
from trackloom.schemas import EXPORT_COLUMNS

_CORRUPT = "_corrupt"
_MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in [*EXPORT_COLUMNS.values(), _CORRUPT]]
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
_BLANKS = " \t\n\r\x0b\x0c"


def split_key_value(lines: DataFrame, line: str = "value") -> DataFrame:
    """Cut a line at its first ``:`` into ``key`` and ``value``; lines without one are dropped."""
    others = [name for name in lines.columns if name not in (line, "key", "value")]
    parts = F.split(F.btrim(F.col(line), F.lit(_BLANKS)), ":", 2)
    cut = lines.select(*others, parts.alias("_parts")).filter(F.size("_parts") == 2)
    return cut.select(*others, F.col("_parts")[0].alias("key"), F.col("_parts")[1].alias("value"))


def filter_key(rows: DataFrame, key: str) -> DataFrame:
    """Keep one device."""
    return rows.filter(F.col("key") == key)


def flatten_export(rows: DataFrame, value: str = "value") -> DataFrame:
    """Output messages to the twelve CSV columns; rows that are not JSON objects are dropped."""
    others = [name for name in rows.columns if name not in ("key", value, *EXPORT_COLUMNS)]
    # What follows an object makes the text undecodable.
    text = F.when(is_one_object(F.col(value)), F.col(value))
    parsed = rows.select(*others, F.from_json(text, _MESSAGE, _OPTIONS).alias("_out"))
    good = F.col("_out").isNotNull() & F.col(f"_out.{_CORRUPT}").isNull()
    flat = keep_rows(parsed, good).select(
        *others,
        *[
            empty_if_null(F.col(f"_out.{field}")).alias(name)
            for name, field in EXPORT_COLUMNS.items()
        ],
    )
    return flat.withColumn("timestamp", iso_timestamp(F.col("timestamp")))
