"""Streams that remember across micro-batches, and go on after any loss.

Each micro-batch reads what the entry before it left in a ledger, works on plain tables, and commits output
and memory as one entry. A micro-batch that is replayed finds its epoch in the ledger, or its offsets, and does
nothing. Messages with offsets are known again by a stream with a new checkpoint folder too; other rows are not,
so such a stream must begin where the old one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackloom.operators.decode import has_json_form, quarantine_batches, split_ok_error
from trackloom.operators.offsets import BATCH, BATCH_MESSAGES, assign_batches, batch_summary
from trackloom.operators.recovery import (
    ENGINE,
    RETRY,
    merge_intervals,
    offset_intervals,
    retry_verdicts,
    unseen_messages,
)
from trackloom.operators.routes import NO_ROUTE, first_routes
from trackloom.operators.slices import with_position
from trackloom.operators.smooth import smooth, smooth_or_reject
from trackloom.operators.snap import RoadIndex
from trackloom.operators.track import ORDER, UNIT
from trackloom.operators.units import split_by_units
from trackloom.schemas import FIX_COLUMNS
from trackloom.streaming.jobs import typed_stream
from trackloom.streaming.ledger import ENTRY, Ledger

Step = Callable[[DataFrame, int | None], None]
Routes = DataFrame | Callable[[], DataFrame]

OFFSETS = "partition int, first bigint, last bigint"
FIGURES = "outputs bigint, written bigint"
WAITING = "partition int, offset bigint, value string, batch_id bigint, attempts int"


def start(source: DataFrame, step: Step, checkpoint: str, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """Run a step on every micro-batch."""
    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "100 milliseconds"})).start()


def _ready(roads: DataFrame | RoadIndex, routes: Routes) -> tuple[RoadIndex, Callable[[], DataFrame]]:
    index = roads if isinstance(roads, RoadIndex) else RoadIndex.build(roads).persist()
    if callable(routes):
        return index, lambda: first_routes(routes())
    fleet = first_routes(routes).persist()
    return index, lambda: fleet


def retrying_step(
    ledger: Ledger,
    roads: DataFrame | RoadIndex,
    routes: Routes,
    max_attempts: int | None = 3,
    text: str = ENGINE,
    batch_messages: int = BATCH_MESSAGES,
    lenient: bool = False,
) -> Step:
    """Smooth message batches; those that fail are tried again with the next micro-batch.

    Messages have ``value``, ``partition`` and ``offset``. A batch keeps its messages for all attempts; its
    ``batch_id`` is its first offset. It is given up if every error of it contains ``text``, or after
    ``max_attempts``. Give ``routes`` as a function to have them read anew each time, so that a route that was
    missing may be there.

    Tables of the ledger: logs ``output``, ``rejected`` (messages with ``error``, ``attempts`` and ``verdict``), ``batches``
    (``batch_summary`` of what was read) and ``figures`` (rows of output, and those of them that have a JSON form: counted
    while they are written, without another read); states ``retry`` (messages that wait) and ``offsets`` (what
    has been read, as intervals).
    """
    index, fleet = _ready(roads, routes)
    kept = ["partition", "offset", "value", "batch_id", "attempts"]

    def step(messages: DataFrame, epoch: int | None) -> None:
        read = ledger.state("offsets", OFFSETS)
        texts = messages.select(F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"), F.col("value").cast("string").alias("value"))
        # read twice below, from the source once
        texts = texts.persist()
        fresh = unseen_messages(texts, read).persist()
        batches = assign_batches(fresh, batch_messages)
        first = batches.groupBy(*BATCH).agg(F.min("offset").alias("_first"))
        named = batches.join(first, list(BATCH)).withColumn("batch_id", F.col("_first")).withColumn("attempts", F.lit(0))
        typed = typed_stream(named.select(*kept).unionByName(ledger.state("retry", WAITING)), lenient=lenient).persist()
        try:
            # an epoch of a stream without a new message is a replay
            if (typed if epoch is None else fresh).isEmpty():
                return
            good, bad = quarantine_batches(typed, BATCH)
            smoothed, lost = smooth_or_reject(good, index.around(good), fleet(), BATCH, ["offset"], bounded=True, unique_routes=True)
            _, without_route = split_by_units(good.select(*kept), lost.select(*BATCH).distinct(), BATCH)
            failed = bad.select(*kept, "error").unionByName(without_route.withColumn("error", F.lit(NO_ROUTE)))
            judged = retry_verdicts(failed, max_attempts, text).withColumn("attempts", F.col("attempts") + 1).persist()
            more = offset_intervals(fresh).unionByName(read)
            counts = Observation()
            counted = [F.count(F.lit(1)).alias("outputs"), F.count_if(has_json_form()).alias("written")]
            tables = {
                "output": smoothed.observe(counts, *counted),
                "figures": lambda: ledger.spark.createDataFrame([(counts.get["outputs"], counts.get["written"])], FIGURES),
                "batches": batch_summary(typed),
                "rejected": judged.filter(F.col("verdict") != RETRY),
                "retry": judged.filter(F.col("verdict") == RETRY).select(*kept),
                "offsets": merge_intervals(more.select("partition", "first", "last")),
            }
            ledger.commit(tables, epoch)
            judged.unpersist()
        finally:
            typed.unpersist()
            fresh.unpersist()
            texts.unpersist()

    return step


def retry_waiting(ledger: Ledger, step: Step) -> None:
    """One more attempt for the batches that wait, without new messages. The stream must not run meanwhile."""
    step(ledger.spark.createDataFrame([], "partition int, offset bigint, value string"), None)


def device_step(
    ledger: Ledger,
    roads: DataFrame | RoadIndex,
    routes: Routes,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    width: int | None = None,
    max_rows: int | None = None,
) -> Step:
    """Smooth whole devices across micro-batches: the last fix of each is remembered, so no pair is lost at an edge.

    Takes typed fixes; rows with ``error`` are set aside. The fixes of a device must not arrive earlier than
    fixes before them that are in a later micro-batch. A gap without a route stays open, since what has been
    written cannot be taken back.

    Tables of the ledger: logs ``output`` and ``rejected``, state ``last``: the last fix of each device. ``emitted``
    is false for a device's only fix: what becomes of it depends on whether another one follows. ``lone_fixes`` has these.
    """
    index, fleet = _ready(roads, routes)
    unit, order = list(unit), list(order)
    names = list(dict.fromkeys([*unit, *order, *FIX_COLUMNS]))

    def step(fixes: DataFrame, epoch: int | None) -> None:
        if epoch is not None and ledger.holds(epoch):
            return
        marked = fixes if "error" in fixes.columns else fixes.withColumn("error", F.lit(None).cast("string"))
        good, bad = split_ok_error(marked)
        fresh = good.select(*names).withColumn("emitted", F.lit(False)).persist()
        try:
            last = ledger.state("last", fresh.schema)
            idle, back = split_by_units(last, fresh.select(*unit).distinct(), unit)
            rows = fresh.unionByName(back)
            newest = rows.groupBy(*unit).agg(
                F.count(F.lit(1)).alias("_rows"), F.max_by(F.struct(*fresh.columns), F.struct(*order)).alias("_last")
            )
            lone = newest.filter(F.col("_rows") == 1).select(*unit)
            followed, _ = split_by_units(rows, lone, unit)
            # the mark goes through smoothing as a last order column, which tells no rows apart
            track = smooth(
                followed, index.around(followed), fleet(), unit, [*order, "emitted"], width, on_missing_route="keep_gap", unique_routes=True, max_rows=max_rows
            )
            written = F.col("after_emitted") & (F.col("j") == 0)
            state = newest.select("_rows", "_last.*").withColumn("emitted", F.col("_rows") > 1)
            tables = {
                "output": track.filter(~written).drop("after_emitted"),
                "rejected": bad,
                "last": state.select(*fresh.columns).unionByName(idle),
            }
            ledger.commit(tables, epoch)
        finally:
            fresh.unpersist()

    return step


def lone_fixes(ledger: Ledger) -> DataFrame:
    """Fixes of devices with one fix so far, as they are. For a ledger with an entry."""
    return ledger.log("last").filter((F.col(ENTRY) == ledger.latest) & ~F.col("emitted")).drop(ENTRY, "emitted")


def counting_step(
    ledger: Ledger, order: Sequence[str] = ("offset",), every: int = 10, key: str = "veh_id", max_rows: int | None = None
) -> Step:
    """Count the messages of each vehicle as they come, and report every n-th.

    Tables of the ledger: log ``reports`` (the n-th rows with their ``pos`` in all of the vehicle's), state ``counts`` (key, messages).
    """

    def step(rows: DataFrame, epoch: int | None) -> None:
        if epoch is not None and ledger.holds(epoch):
            return
        kind = rows.schema[key].dataType.simpleString()
        counts = ledger.state("counts", f"{key} {kind}, messages bigint")
        before = counts.withColumnRenamed("messages", "_before")
        placed = with_position(rows, [key], order, "pos", max_rows=max_rows).join(before, key, "left")
        pos = F.col("pos") + F.coalesce("_before", F.lit(0))
        more = rows.groupBy(key).agg(F.count(F.lit(1)).alias("messages"))
        tables = {
            "reports": placed.withColumn("pos", pos).drop("_before").filter(F.pmod("pos", F.lit(every)) == 0),
            "counts": counts.unionByName(more).groupBy(key).agg(F.sum("messages").alias("messages")),
        }
        ledger.commit(tables, epoch)

    return step
