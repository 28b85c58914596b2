"""One registered query per operator. Each runs over whole tables.

Coordinates are shown as whole micro-degrees and distances as whole millimetres, so
that two engines can agree on them exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom import functions as X
from trackloom.operators import counts, decode, export, offsets, recovery, routes, snap, track
from trackloom.operators.slices import with_next
from trackloom.operators.smooth import smooth, smooth_or_reject
from trackloom.plans import inputs
from trackloom.schemas import OUTPUT_NAMES, PROCESSED, RAW_FIELDS
from trackloom.sources import keyed_lines
from trackloom.streaming import feed_raw

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BY_DEVICE = ("device_id",)
BY_TIME = ("timestamp", "offset")


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def mm(metres: Column) -> Column:
    return F.floor(metres * 1e3 + 0.5).cast("bigint")


def mdeg(name: str) -> Column:
    return X.micro_degrees(F.col(name))


def number_text(column: Column) -> Column:
    """Kind of a double, since NaN and infinity have no common rendering."""
    return (
        F.when(column.isNull(), "none")
        .when(F.isnan(column), "nan")
        .when(F.abs(column) == float("inf"), "infinite")
        .otherwise("finite")
    )


def finite(column: Column) -> Column:
    return F.when(number_text(column) == "finite", column)


# --- positions and order -------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track.consecutive_pairs(inputs.points(spark, sf_dir))


@query
def gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = track.gap_summary(inputs.points(spark, sf_dir))
    return found.select(
        "device_id", "segments", "gaps", F.floor(F.col("path_metres") + 0.5).cast("bigint").alias("path_m")
    )


@query
def consecutive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = track.consecutive_pairs(
        inputs.points(spark, sf_dir), carry=("offset", "latitude", "longitude")
    )
    return pairs.select(
        F.col("offset").alias("event_id"),
        F.col("next.offset").alias("next_id"),
        mdeg("next.latitude").alias("next_mlat"),
        mdeg("next.longitude").alias("next_mlon"),
    )


@query
def segment_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = track.segment_distance(_pairs(spark, sf_dir))
    return measured.select(F.col("offset").alias("event_id"), mm(F.col("metres")).alias("mm"))


@query
def haversine_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    metres = X.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(42.65), F.lit(23.35))
    return inputs.points(spark, sf_dir).select(F.col("offset").alias("event_id"), mm(metres).alias("mm"))


@query
def degrees_to_radians(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.floor(F.radians("latitude") * 1e9 + 0.5).cast("bigint")
    return inputs.points(spark, sf_dir).select(F.col("offset").alias("event_id"), scaled.alias("nano_radians"))


@query
def mean_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = X.mean_speed(F.col("speed"), F.col("next.speed"))
    return _pairs(spark, sf_dir).select(
        F.col("offset").alias("event_id"), F.floor(mean * 1e4 + 0.5).cast("bigint").alias("mean_speed")
    )


@query
def add_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = X.add_seconds(F.col("timestamp"), F.pmod("offset", F.lit(100)))
    return inputs.points(spark, sf_dir).select(
        F.col("offset").alias("event_id"), F.unix_micros(later).alias("later_us")
    )


@query
def micro_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.points(spark, sf_dir).select(
        F.col("offset").alias("event_id"), mdeg("latitude").alias("mlat"), mdeg("longitude").alias("mlon")
    )


@query
def unit_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = track.unit_bounds(inputs.points(spark, sf_dir), ["vehicle_id", "partition"], ["timestamp", "offset"])
    return marked.select(
        F.col("offset").alias("event_id"),
        F.col("is_last").cast("int").alias("is_last"),
        F.col("alone").cast("int").alias("alone"),
    )


@query
def every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.raw_rows(spark, sf_dir).select("veh_id", "event_id")
    return track.every_nth(rows, 10, ("veh_id",), ("event_id",))


@query
def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.validate_raw(inputs.raw_rows(spark, sf_dir)).select("veh_id", "event_id")
    return track.tracks(rows, ("veh_id",), ("event_id",))


def _by_the_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixes that share their time with all others of a day."""
    return inputs.points(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))


@query
def row_bounded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = track.consecutive_pairs(_by_the_day(spark, sf_dir), carry=("offset",), max_rows=1000)
    return pairs.select(F.col("offset").alias("event_id"), F.col("next.offset").alias("next_id"))


@query
def row_bounded_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = track.tracks(_by_the_day(spark, sf_dir), ("device_id",), ("timestamp", "offset"), max_rows=1000)
    return placed.select(F.col("offset").alias("event_id"), "pos")


@query
def track_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.validate_raw(inputs.raw_rows(spark, sf_dir)).select("veh_id", "event_id")
    lists = track.track_lists(rows, ["event_id"], 100, ("veh_id",), ("event_id",))
    return lists.select(
        "veh_id",
        "part",
        F.size("items").cast("bigint").alias("length"),
        F.element_at("items", 1)["event_id"].alias("first_id"),
        F.element_at("items", -1)["event_id"].alias("last_id"),
    )


# --- decoding and typing -------------------------------------------------------------


@query
def decode_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.decode_raw(inputs.derive(spark, sf_dir, "MESSAGES"))
    return decoded.select("event_id", *RAW_FIELDS, F.col("error").isNotNull().cast("int").alias("failed"))


@query
def validate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.with_validation_error(inputs.raw_rows(spark, sf_dir)).select("event_id", "error")


@query
def to_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = decode.to_processed(inputs.raw_rows(spark, sf_dir))
    return typed.select(
        "event_id",
        "error",
        finite(F.col("latitude")).alias("latitude"),
        number_text(F.col("latitude")).alias("latitude_kind"),
        finite(F.col("longitude")).alias("longitude"),
        "speed",
        "altitude",
        "signal",
        "satellites",
        F.unix_millis("timestamp").alias("ts_ms"),
        "device_id",
        "vehicle_id",
        "status",
        "in_depot",
    )


@query
def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat = X.strict_double(F.col("lat"))
    return inputs.raw_rows(spark, sf_dir).select(
        "event_id",
        finite(lat).alias("lat"),
        number_text(lat).alias("lat_kind"),
        X.strict_long(F.col("signal")).alias("signal"),
        X.loose_float_ok(F.col("lat")).cast("int").alias("loose_float"),
        X.loose_int_ok(F.col("ts")).cast("int").alias("loose_int"),
    )


@query
def missing_as_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    sparse = F.when(F.pmod("event_id", F.lit(3)) != 0, F.col("event_type"))
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", X.empty_if_null(sparse).alias("text"))


@query
def split_ok_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = decode.split_ok_error(decode.to_processed(inputs.raw_rows(spark, sf_dir)))
    return good.select("event_id", F.lit("ok").alias("side")).unionByName(
        bad.select("event_id", F.lit("error").alias("side"))
    )


@query
def stamp_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").withColumn("now", F.col("ts").cast("timestamp"))
    return decode.stamp_ingest(events, F.col("now")).select("event_id", "current_ts", "formatted_ts")


@query
def epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = X.from_epoch_ms(X.strict_long(F.col("ts")))
    return inputs.raw_rows(spark, sf_dir).select(
        "event_id", F.unix_micros(stamp).alias("us"), F.year(stamp).cast("bigint").alias("year")
    )


@query
def format_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_rows(spark, sf_dir).select("event_id", X.readable_time(F.col("ts")).alias("formatted"))


@query
def iso_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamps = inputs.derive(spark, sf_dir, "ISO_TEXT")
    return stamps.select("event_id", X.iso_timestamp(F.col("stamp")).alias("iso"))


@query
def vehicle_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicle = F.concat(F.lit("A"), F.col("user_id").cast("string"))
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", X.vehicle_key(vehicle).alias("key"))


@query
def encode_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twelve fields. The JSON is read back, since two engines spell a double differently."""
    good, _ = decode.split_ok_error(decode.to_processed(inputs.raw_rows(spark, sf_dir)))
    kinds = {field.name: field.dataType for field in PROCESSED}
    message = T.StructType([T.StructField(field, kinds[name]) for name, field in OUTPUT_NAMES.items()])
    read_back = decode.encode_output(good).withColumn("m", F.from_json("value", message))
    fields = {name: F.col(f"m.{field}") for name, field in OUTPUT_NAMES.items() if name != "timestamp"}
    return read_back.select(
        "event_id", "key", F.unix_millis("m.Timestamp").alias("ts_ms"), *[column.alias(name) for name, column in fields.items()]
    )


@query
def feed_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.raw_rows(spark, sf_dir).drop("part")
    now = F.timestamp_millis(F.lit(1735689600000) + F.col("event_id"))
    return feed_raw(rows, now)


# --- export --------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.derive(spark, sf_dir, "LINES")


@query
def split_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.split_key_value(_lines(spark, sf_dir))


@query
def flatten_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.flatten_export(export.split_key_value(_lines(spark, sf_dir)))


@query
def filter_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.filter_key(export.split_key_value(_lines(spark, sf_dir)), "D7")


@query
def export_keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_lines(export.split_key_value(_lines(spark, sf_dir)))


# --- batches and offsets -------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed messages in batches; the dirt is thin enough to leave whole batches clean."""
    typed = decode.to_processed(inputs.raw_rows(spark, sf_dir))
    return offsets.assign_batches(inputs.offset_rows(typed.select("event_id", "part", "error")))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.offset_rows(inputs.derive(spark, sf_dir, "RAW").select("event_id", "part"))
    half = F.floor(F.max("offset") / F.lit(2)).cast("bigint")
    return rows.groupBy("partition").agg(half.alias("offset")).filter(F.col("partition") != 3)


@query
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = _messages(spark, sf_dir)
    return batches.select("event_id", F.col("partition").cast("bigint").alias("partition"), "offset", "batch_id")


@query
def batch_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = _messages(spark, sf_dir)
    return batches.select("event_id", X.batch_key(F.col("partition"), F.col("offset")).alias("key"))


@query
def quarantine_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, rejected = decode.quarantine_batches(_messages(spark, sf_dir))
    return kept.select("event_id", F.lit("kept").alias("side")).unionByName(
        rejected.select("event_id", F.lit("rejected").alias("side"))
    )


@query
def start_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = offsets.start_from(_messages(spark, sf_dir), _stored(spark, sf_dir))
    return found.select("event_id", "offset")


@query
def skip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = offsets.skip_processed(_messages(spark, sf_dir), _stored(spark, sf_dir))
    return found.select("event_id", "batch_id")


@query
def drop_inflight_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _messages(spark, sf_dir).select(F.col("partition").cast("bigint").alias("partition"), "offset", "event_id")
    again = rows.withColumn("copies", F.sequence(F.lit(0), F.pmod("event_id", F.lit(4)).cast("int")))
    return offsets.drop_inflight_duplicates(again.withColumn("copy", F.explode("copies")).select(*rows.columns))


@query
def last_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = inputs.derive(spark, sf_dir, "COMMITS").withColumnsRenamed({"part": "partition", "off": "offset"})
    return offsets.last_offsets(commits)


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs are the rows of good batches; written are those of them that have a JSON form."""
    typed = decode.to_processed(inputs.raw_rows(spark, sf_dir)).withColumnRenamed("timestamp", "ts")
    messages = offsets.assign_batches(inputs.offset_rows(typed)).withColumnRenamed("ts", "timestamp")
    kept, _ = decode.quarantine_batches(messages)
    found = offsets.batch_summary(messages, kept, decode.encode_output(kept))
    return found.withColumn("partition", F.col("partition").cast("bigint"))


@query
def all_errors_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = offsets.all_errors_match(_messages(spark, sf_dir), "latitude")
    return found.select(
        F.col("partition").cast("bigint").alias("partition"), "batch_id", F.col("all_match").cast("int").alias("all_match")
    )


@query
def offset_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of offsets, where every 97th message is missing."""
    read = _messages(spark, sf_dir).filter(F.pmod("event_id", F.lit(97)) != 0)
    found = recovery.offset_intervals(read)
    return found.select(F.col("partition").cast("bigint").alias("partition"), "first", "last")


@query
def unseen_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come twice, of which most have been read."""
    messages = _messages(spark, sf_dir).select("event_id", "partition", "offset")
    read = recovery.offset_intervals(messages.filter(F.pmod("event_id", F.lit(997)) > 2))
    found = recovery.unseen_messages(messages.unionByName(messages), read)
    return found.select("event_id", "offset")


@query
def retry_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = decode.quarantine_batches(_messages(spark, sf_dir))
    tried = failed.withColumn("attempts", F.pmod("partition", F.lit(3)))
    return recovery.retry_verdicts(tried, 2, "latitude").select("event_id", "verdict")


@query
def contains_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", X.has_text(F.col("props"), "7").cast("int").alias("found"))


@query
def count_per_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_per_vehicle(decode.validate_raw(inputs.raw_rows(spark, sf_dir)))


@query
def total_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.total_messages(decode.validate_raw(inputs.raw_rows(spark, sf_dir)))


@query
def count_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_vehicles(decode.validate_raw(inputs.raw_rows(spark, sf_dir)))


# --- roads and routes ----------------------------------------------------------------


@query
def snap_to_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapped = snap.snap_to_road(
        inputs.derive(spark, sf_dir, "SCATTERED"), inputs.derive(spark, sf_dir, "ROADS"), keep_hit=True
    )
    return snapped.select(
        "event_id", "seg_id", mm(F.col("road_metres")).alias("mm"), mdeg("latitude").alias("mlat"), mdeg("longitude").alias("mlon")
    )


def _device_routes(points: DataFrame) -> DataFrame:
    return inputs.straight_routes(inputs.gaps(points), "offset")


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = inputs.gaps(inputs.points(spark, sf_dir))
    return routes.route_lookup(gaps, inputs.straight_routes(gaps, "offset"))


@query
def first_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = routes.first_in_list(_device_routes(inputs.points(spark, sf_dir)), routes.ROUTE_KEY, "route_no")
    return first.select(*routes.ROUTE_KEY, "route_no", F.size("coordinates").cast("bigint").alias("coordinates"))


@query
def route_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select(
        F.col("offset").alias("event_id"),
        F.when(F.col("error").isNull(), F.size("coordinates")).cast("bigint").alias("coordinates"),
        "error",
    )


@query
def inner_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = routes.inner_coordinates(F.col("coordinates"))
    return _device_routes(inputs.points(spark, sf_dir)).select(
        "route_no",
        F.size(inner).cast("bigint").alias("length"),
        X.micro_degrees(F.get(inner, 0)["lat"]).alias("first_mlat"),
        X.micro_degrees(F.get(inner, F.size(inner) - 1)["lon"]).alias("last_mlon"),
    )


@query
def explode_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.explode_route(_device_routes(inputs.points(spark, sf_dir))).select(
        "route_no", F.col("i").cast("bigint").alias("i"), mdeg("lat").alias("mlat"), mdeg("lon").alias("mlon")
    )


@query
def sample_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.sample_step(_device_routes(inputs.points(spark, sf_dir))).select(
        "route_no", F.col("i").cast("bigint").alias("i"), mdeg("lat").alias("mlat"), mdeg("lon").alias("mlon")
    )


@query
def step_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    step = X.ratio_step(F.pmod("event_id", F.lit(97)), 6)
    return events.select("event_id", step.cast("bigint").alias("step"))


@query
def filter_near_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = routes.explode_route(_routed(spark, sf_dir))
    return routes.filter_near_ends(spread).select(
        F.col("offset").alias("event_id"), F.col("i").cast("bigint").alias("i")
    )


@query
def impute_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = routes.explode_route(_routed(spark, sf_dir)).withColumn("event_id", F.col("offset"))
    return routes.impute_fields(spread).select(
        "event_id",
        F.col("j").cast("bigint").alias("j"),
        mdeg("latitude").alias("mlat"),
        mdeg("longitude").alias("mlon"),
        F.floor(F.col("speed") * 1e4 + 0.5).cast("bigint").alias("speed"),
        F.unix_micros("timestamp").alias("us"),
        "device_id",
        "vehicle_id",
        "altitude",
        "signal",
        "satellites",
        "status",
        "in_depot",
        "formatted_ts",
    )


@query
def impute_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = inputs.points(spark, sf_dir)
    inserted = routes.impute_gaps(fixes, _device_routes(fixes))
    return inserted.select(
        F.col("after_offset").alias("event_id"),
        F.col("j").cast("bigint").alias("j"),
        mdeg("latitude").alias("mlat"),
        mdeg("longitude").alias("mlon"),
        F.unix_micros("timestamp").alias("us"),
    )


@query
def append_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = inputs.points(spark, sf_dir)
    inserted = routes.impute_gaps(fixes, _device_routes(fixes))
    both = routes.append_imputed(
        fixes.withColumns({"event_id": F.col("offset"), "j": F.lit(0)}).select("event_id", "j", "speed"),
        inserted.select(F.col("after_offset").alias("event_id"), "j", "speed"),
    )
    return both.select("event_id", F.col("j").cast("bigint").alias("j"), F.floor(F.col("speed") * 1e4 + 0.5).cast("bigint").alias("speed"))


def _smoothed(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("after_offset").alias("event_id"),
        F.col("j").cast("bigint").alias("j"),
        mdeg("latitude").alias("mlat"),
        mdeg("longitude").alias("mlon"),
        F.unix_micros("timestamp").alias("us"),
        "device_id",
        "status",
        "altitude",
    )


@query
def smooth_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units are devices; a gap without a route stays open."""
    fixes = inputs.points(spark, sf_dir)
    return _smoothed(
        smooth(
            fixes,
            inputs.derive(spark, sf_dir, "ROADS"),
            _device_routes(fixes),
            on_missing_route="keep_gap",
        )
    )


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, dict]:
    """Message batches in arrival order and routes between their fixes, with the options that say so."""
    messages = inputs.points(spark, sf_dir).withColumnRenamed("offset", "event_id")
    messages = messages.withColumn("part", F.col("partition").cast("bigint")).drop("partition")
    batches = offsets.assign_batches(inputs.offset_rows(messages), 7).withColumn("offset", F.col("event_id"))
    unit, order = ["partition", "batch_id"], ["offset"]
    pairs = track.consecutive_pairs(batches, unit, order, bounded=True)
    fleet_routes = inputs.straight_routes(routes.find_gaps(pairs), "offset")
    return batches, fleet_routes, {"unit": unit, "order": order, "bounded": True}


@query
def smooth_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units are message batches in arrival order; a gap without a route removes its batch."""
    batches, fleet_routes, options = _batches(spark, sf_dir)
    return _smoothed(smooth(batches, inputs.derive(spark, sf_dir, "ROADS"), fleet_routes, **options))


@query
def smooth_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixes of the batches that smoothing sets aside, and why."""
    batches, fleet_routes, options = _batches(spark, sf_dir)
    _, lost = smooth_or_reject(batches, inputs.derive(spark, sf_dir, "ROADS"), fleet_routes, **options)
    return lost.select(F.col("after_offset").alias("event_id"), mdeg("latitude").alias("mlat"), mdeg("longitude").alias("mlon"), "error")


@query
def output_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the one after it in its track, which shows the order."""
    fixes = inputs.points(spark, sf_dir)
    inserted = routes.impute_gaps(fixes, _device_routes(fixes))
    rows = routes.append_imputed(
        fixes.select("device_id", "timestamp", "offset", F.lit(0).alias("j")),
        inserted.select(
            "device_id", F.col("after_timestamp").alias("timestamp"), F.col("after_offset").alias("offset"), "j"
        ),
    )
    ordered = track.output_order(with_next(rows, ["device_id"], ["timestamp", "offset", "j"], ["offset", "j"]))
    return ordered.select(
        "device_id",
        F.unix_micros("timestamp").alias("us"),
        F.col("offset").alias("event_id"),
        F.col("j").cast("bigint").alias("j"),
        F.col("next.offset").alias("next_id"),
        F.col("next.j").cast("bigint").alias("next_j"),
    )
