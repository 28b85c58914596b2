"""Streaming jobs.

Smoothing never looks beyond one micro-batch, so its windows run inside
``foreachBatch``; decoding and typing are plain stream projections. Offsets are
committed through the checkpoint once the sink has returned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from trackloom.operators.decode import (
    decode_raw,
    quarantine_batches,
    stamp_ingest,
    to_processed,
    validate_raw,
)
from trackloom.operators.offsets import BATCH_MESSAGES, assign_batches
from trackloom.operators.routes import first_routes
from trackloom.operators.smooth import smooth_or_reject
from trackloom.operators.snap import RoadIndex
from trackloom.sources.writers import (
    MESSAGE_IDENTITY,
    raw_messages,
    smoothed_messages,
    write_topic,
)

Sink = Callable[[DataFrame, int], None]


def typed_stream(source: DataFrame, value: str = "value", lenient: bool = False) -> DataFrame:
    """Messages to typed fixes with an ``error`` column; works on tables and streams alike."""
    return to_processed(decode_raw(source, value, lenient))


def epoch_files(path: str, format: str = "parquet") -> Sink:
    """A file sink that a replayed micro-batch overwrites instead of doubling."""

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").format(format).save(f"{path}/epoch={epoch}")

    return write


def topic_messages(servers: str, topic: str, format: str = "kafka") -> Sink:
    """A topic sink. Delivery is at least once: a replayed micro-batch is sent again.

    Rows of message batches carry the place they come from as header, so that ``one_of_each`` reads them once.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        identity = MESSAGE_IDENTITY if set(MESSAGE_IDENTITY) <= set(rows.columns) else None
        write_topic(smoothed_messages(rows, one_writer_per_key=True, identity=identity), servers, topic, format)

    return write


def smooth_stream(
    source: DataFrame,
    roads: DataFrame | RoadIndex,
    routes: DataFrame,
    sink: Sink,
    checkpoint: str,
    unit: Sequence[str] = ("partition", "batch_id"),
    order: Sequence[str] = ("offset",),
    batch_messages: int = BATCH_MESSAGES,
    on_error: str = "drop_unit",
    on_missing_route: str = "drop_unit",
    rejected: Sink | None = None,
    trigger: dict[str, Any] | None = None,
    lenient: bool = False,
) -> StreamingQuery:
    """Read, decode, type, set failed batches aside, smooth, write, commit.

    ``source`` has ``value``, ``partition`` and ``offset``. Batches of at most
    ``batch_messages`` are cut inside the micro-batch, whose own size the source bounds.
    A table of roads is indexed once and the first route of each key is found once, before the first
    micro-batch needs them; both are kept in the cluster. ``rejected`` gets the messages that failed to decode or type, and the
    fixes of units that were set aside because a gap has no route.
    A micro-batch that is replayed after a failure gives the sink the same epoch number.
    """

    index = roads if isinstance(roads, RoadIndex) else RoadIndex.build(roads).persist()
    fleet_routes = first_routes(routes).persist()

    def run(messages: DataFrame, epoch: int) -> None:
        batches = assign_batches(typed_stream(messages, lenient=lenient), batch_messages)
        batches.persist()
        try:
            good, bad = quarantine_batches(batches, unit, on_error)
            smoothed, lost = smooth_or_reject(
                good, index.around(good), fleet_routes, unit, order, on_missing_route=on_missing_route, bounded=True, unique_routes=True
            )
            sink(smoothed, epoch)
            if rejected is not None:
                rejected(bad.unionByName(lost, allowMissingColumns=True), epoch)
        finally:
            batches.unpersist()

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
        .start()
    )


def feed_raw(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw rows to messages: validate, stamp, key. For a table or a stream of rows."""
    return raw_messages(stamp_ingest(validate_raw(rows), now))
