"""Sources.

The Kafka readers need Spark's Kafka package on the classpath. They also read a topic kept in files, with
``format="filetopic"`` (``sources/file_topic.py``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.operators.export import split_key_value
from trackloom.schemas import RAW_FIELDS
from trackloom.sources.writers import IDENTITY


def read_raw_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Header CSV to text columns. An empty cell is null; a doubled quote in a quoted cell is one.

    ``multi_line`` allows line breaks in quoted cells; a file is then read by one task, whatever its size.

    Without ``columns`` the names come from the header; with them the file's header
    must carry these names in this order, and no file is opened to plan the read.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if columns is None:
        return reader.option("inferSchema", False).csv(path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def starting_offsets(topic: str, offsets: Mapping[int, int]) -> str:
    """The Kafka option that starts each partition at its own offset."""
    return json.dumps({topic: {str(partition): offset for partition, offset in offsets.items()}})


def _text_columns(source: DataFrame) -> DataFrame:
    names = ["topic", "partition", "offset", "timestamp", *[n for n in ("headers",) if n in source.columns]]
    text: list[Column] = [F.col(name).cast("string").alias(name) for name in ("key", "value")]
    return source.select(*text, *[F.col(name) for name in names])


def read_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_messages: int | None = None,
    options: Mapping[str, str] | None = None,
    format: str = "kafka",
) -> DataFrame:
    """Continuous read of all partitions of a topic, from the latest offset by default.

    ``max_messages`` bounds a micro-batch.
    """
    reader = (
        spark.readStream.format(format)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return _text_columns(reader.options(**(options or {})).load())


def read_topic_bounded(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    options: Mapping[str, str] | None = None,
    format: str = "kafka",
) -> DataFrame:
    """The whole topic, from its first offset to the last one at the time of reading."""
    reader = (
        spark.read.format(format)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", "latest")
    )
    return _text_columns(reader.options(**(options or {})).load())


def one_of_each(messages: DataFrame, watermark: str | None = None) -> DataFrame:
    """Of messages that have the same header ``id``, one; all that have none.

    A writer that repeats itself sends the same id again, so what was sent twice reads back as once. Read
    the topic with the option ``includeHeaders``. On a stream give a ``watermark`` delay on ``timestamp``.
    """
    named = F.filter("headers", lambda h: h["key"] == IDENTITY)
    marked = messages.withColumn("_id", F.try_element_at(named, F.lit(1))["value"].cast("string"))
    with_id, without = marked.filter(F.col("_id").isNotNull()), marked.filter(F.col("_id").isNull())
    if watermark is None:
        once = with_id.dropDuplicates(["_id"])
    else:
        once = with_id.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["_id"])
        without = without.withWatermark("timestamp", watermark)
    return once.unionByName(without).drop("_id")


def read_keyed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines ``key:json`` as ``key`` and ``value``."""
    return split_key_value(spark.read.text(path))


def read_lines_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Text files of raw messages, one JSON object per line, as a stream with ``value``.

    A stand-in for the topic where there is no broker.
    """
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_raw_csv_stream(spark: SparkSession, path: str, columns: Sequence[str] = tuple(RAW_FIELDS), multi_line: bool = False) -> DataFrame:
    """Header CSV files that keep arriving in a folder; see ``read_raw_csv``."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .csv(path)
    )
