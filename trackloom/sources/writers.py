"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions import vehicle_key
from trackloom.operators.decode import encode_output
from trackloom.schemas import EXPORT_COLUMNS

# The header that names a message for good, and what names a row of a smoothed batch.
IDENTITY = "id"
MESSAGE_IDENTITY = ("partition", "after_offset", "j")


def smoothed_messages(
    fixes: DataFrame,
    sequence: Sequence[str] | None = None,
    one_writer_per_key: bool = False,
    identity: Sequence[str] | None = None,
) -> DataFrame:
    """Smoothed fixes as messages: key is the device, value the JSON text.

    ``identity`` names columns that tell the fixes of a track apart whenever it is smoothed again, such as
    ``MESSAGE_IDENTITY``. They go with the message as its header ``id``, by which readers keep one of each.

    ``sequence`` is the order within a device: by default the ``after_`` columns that
    smoothing leaves, then ``j``.

    Rows are range-partitioned by device and sequence, so a busy device is spread over
    tasks, each of which writes in order. ``one_writer_per_key`` hashes by device
    instead: a strict order per key at the broker. Use it where a device's share is
    bounded, such as in a micro-batch.
    """
    if sequence is None:
        sequence = [name for name in fixes.columns if name.startswith("after_")] + ["j"]
    columns = ["key", "value"]
    encoded = encode_output(fixes)
    if identity is not None:
        text = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in identity])
        header = F.struct(F.lit(IDENTITY).alias("key"), text.cast("binary").alias("value"))
        encoded = encoded.withColumn("headers", F.array(header))
        columns.append("headers")
    messages = encoded.select(*columns, *[name for name in sequence if name not in columns])
    if one_writer_per_key:
        placed = messages.repartition("key")
    else:
        placed = messages.repartitionByRange("key", *sequence)
    return placed.sortWithinPartitions("key", *sequence).select(*columns)


def raw_messages(rows: DataFrame) -> DataFrame:
    """Raw rows as messages: key is the vehicle's hash, value the row as JSON text.

    A row without a vehicle id has no key and is not sent. Field names and order are
    those of the row.
    """
    has_vehicle = F.coalesce(F.col("veh_id"), F.lit("")) != ""
    return rows.filter(has_vehicle).select(
        vehicle_key(F.col("veh_id")).alias("key"),
        F.to_json(F.struct(*rows.columns)).alias("value"),
    )


def write_topic(messages: DataFrame, servers: str, topic: str, format: str = "kafka") -> None:
    """Send ``key`` and ``value`` to a Kafka topic; a failed task is retried by Spark."""
    columns = [name for name in ("key", "value", "headers") if name in messages.columns]
    (
        messages.select(*columns)
        .write.format(format)
        .mode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def keyed_lines(messages: DataFrame) -> DataFrame:
    """Messages as text lines ``key:value``."""
    return messages.select(F.concat_ws(":", "key", "value").alias("value"))


def write_keyed_lines(messages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    keyed_lines(messages).write.mode(mode).text(path)


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The twelve export columns with a header; null and ``''`` are both an empty cell."""
    (
        rows.select(*EXPORT_COLUMNS)
        .write.mode(mode)
        .option("header", True)
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("escape", '"')
        .csv(path)
    )
