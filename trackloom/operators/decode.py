"""From message text to typed fixes, with an ``error`` column instead of exceptions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.functions import (
    empty_if_null,
    from_epoch_ms,
    loose_float_ok,
    loose_int_ok,
    readable_time,
    strict_double,
    strict_long,
)
from trackloom.operators.rows import keep_rows
from trackloom.operators.units import split_by_units
from trackloom.schemas import OUTPUT_NAMES, RAW_FIELDS, REQUIRED_FIELDS

NOT_AN_OBJECT = "message is not a JSON object"
CORRUPT = "_corrupt"
_MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in [*RAW_FIELDS, CORRUPT]]
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def is_one_object(text: Column) -> Column:
    """The whole text is one JSON object. A parser alone stops at the object's end.

    What follows the object would have to close both an array and an object around it.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"x":'), text, F.lit("}")))) == 1
    return F.coalesce(F.ltrim(text).startswith("{") & in_array & in_object, F.lit(False))


def decode_raw(messages: DataFrame, value: str = "value", lenient: bool = False) -> DataFrame:
    """JSON text to the twelve raw text fields; ``error`` is set on bad JSON.

    Missing fields become ``''`` and unknown ones are ignored; field names match in
    exact case. A known field that is not JSON text is an error, unless ``lenient``: then
    numbers are taken as their text.
    """
    text = F.col(value).cast("string")
    kept = [F.col(name) for name in messages.columns if name not in (*RAW_FIELDS, "error")]
    parsed = messages.select(
        *kept, text.alias("_text"), F.from_json(text, _MESSAGE, _OPTIONS).alias("_raw")
    )
    bad = F.col("_raw").isNull() | F.col(f"_raw.{CORRUPT}").isNotNull() | ~is_one_object(F.col("_text"))
    if not lenient:
        bad = bad | ~_all_text(F.col("_text"))
    marked = parsed.withColumn("_bad", F.coalesce(bad, F.lit(True)))
    return marked.select(
        *kept,
        *[empty_if_null(F.when(~F.col("_bad"), F.col(f"_raw.{name}"))).alias(name) for name in RAW_FIELDS],
        F.when(F.col("_bad"), F.lit(NOT_AN_OBJECT)).alias("error"),
    )


def _all_text(text: Column) -> Column:
    """Every known field is absent, null or JSON text."""
    document = F.try_parse_json(text)

    def is_text(name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant"))
        return F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))

    return reduce(lambda a, b: a & b, [is_text(name) for name in RAW_FIELDS], document.isNotNull())


def validation_error(columns: Sequence[str]) -> Column:
    """Why a raw row is refused: the first missing field, or a bad number; else null."""
    # The texts of the reasons.
    reason = F
    for name in REQUIRED_FIELDS:
        text = F.col(name) if name in columns else F.lit(None).cast("string")
        missing = F.coalesce(text, F.lit("")) == ""
        reason = reason.when(missing, F.lit(f"Missing required field: {name}"))
    if set(REQUIRED_FIELDS) <= set(columns):
        numeric = (
            loose_float_ok(F.col("lat")) & loose_float_ok(F.col("lon")) & loose_int_ok(F.col("ts"))
        )
        reason = reason.when(~numeric, F.lit("Invalid numeric values"))
    return reason


def with_validation_error(rows: DataFrame) -> DataFrame:
    return rows.withColumn("error", validation_error(rows.columns))


def validate_raw(rows: DataFrame) -> DataFrame:
    """Keep rows with all required fields and numeric lat, lon and ts."""
    return rows.filter(validation_error(rows.columns).isNull())


# Raw field -> (engine column, cast), in the order in which errors are reported.
_CASTS = {
    "lat": ("latitude", strict_double),
    "lon": ("longitude", strict_double),
    "speed": ("speed", strict_double),
    "alt": ("altitude", strict_double),
    "signal": ("signal", strict_long),
    "sats": ("satellites", strict_long),
    "ts": ("timestamp", lambda text: from_epoch_ms(strict_long(text))),
}
_COPIES = {
    "dev_id": "device_id",
    "veh_id": "vehicle_id",
    "status": "status",
    "in_depot": "in_depot",
    "formatted_ts": "formatted_ts",
}


def to_processed(raw: DataFrame) -> DataFrame:
    """Type seven fields and copy five. ``error`` names the first field that fails.

    Other columns stay, but for those with the name of a typed field, such as a message's own ``timestamp``.
    """
    earlier = F.col("error") if "error" in raw.columns else F.lit(None).cast("string")
    targets = [target for target, _ in _CASTS.values()] + list(_COPIES.values())
    kept = [name for name in raw.columns if name not in (*RAW_FIELDS, *targets, "error")]
    texts = {f"_{name}": F.col(name) for name in RAW_FIELDS}
    typed = raw.select(
        *kept,
        *[column.alias(name) for name, column in texts.items()],
        earlier.alias("_earlier"),
        *[cast(F.col(source)).alias(target) for source, (target, cast) in _CASTS.items()],
    )
    failed = F
    for source, (target, _) in _CASTS.items():
        reason = F.concat(F.lit(f"bad {target}: "), F.col(f"_{source}"))
        failed = failed.when(F.col(target).isNull(), reason)
    return typed.select(
        *kept,
        *[target for target, _ in _CASTS.values()],
        *[empty_if_null(F.col(f"_{source}")).alias(target) for source, target in _COPIES.items()],
        F.coalesce("_earlier", failed).alias("error"),
    )


def split_ok_error(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the ``error`` column, and the failed rows with it."""
    good = keep_rows(rows, F.col("error").isNull()).drop("error")
    return good, keep_rows(rows, F.col("error").isNotNull())


def quarantine_batches(
    rows: DataFrame,
    unit: Sequence[str] = ("partition", "batch_id"),
    on_error: str = "drop_unit",
    bounded: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows to go on with, and rows set aside.

    ``drop_unit`` sets a whole unit aside if any of its rows failed; ``drop_row``
    only the failed rows. Bounded units are marked in one window. Say ``bounded=False`` for
    units of any size, such as devices: then the failed units are joined back.
    """
    if on_error == "drop_row":
        return split_ok_error(rows)
    if on_error != "drop_unit":
        raise ValueError(f"on_error must be drop_unit or drop_row, not {on_error!r}")
    if bounded:
        marked = with_failed_unit(rows, F.col("error").isNotNull(), unit)
        kept, rejected = (keep_rows(marked, side).drop("_failed") for side in (~F.col("_failed"), F.col("_failed")))
    else:
        failed_units = keep_rows(rows, F.col("error").isNotNull()).select(*unit).distinct()
        kept, rejected = split_by_units(rows, failed_units, unit)
    return kept.drop("error"), rejected


def with_failed_unit(rows: DataFrame, failed: Column, unit: Sequence[str]) -> DataFrame:
    """Adds ``_failed``: some row of the unit failed. For units with a bounded number of rows."""
    return rows.withColumn("_failed", F.max(failed).over(Window.partitionBy(*unit)))


def stamp_ingest(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Add ``current_ts`` (epoch ms) and ``formatted_ts``: the time of sending, not of the fix."""
    ms = F.unix_millis(F.current_timestamp() if now is None else now)
    return rows.withColumn("current_ts", ms).withColumn(
        "formatted_ts", readable_time(ms.cast("string"))
    )


def has_json_form() -> Column:
    """A fix whose numbers are all finite."""
    # NaN counts as larger than infinity.
    numbers = [F.abs(name) < F.lit(float("inf")) for name in ("latitude", "longitude", "speed", "altitude")]
    return reduce(lambda a, b: a & b, numbers)


def encode_output(fixes: DataFrame) -> DataFrame:
    """Add ``key`` (device) and ``value`` (JSON with the output field names).

    Rows with NaN or infinite numbers have no JSON form and are left out.
    """
    message = F.struct(*[F.col(name).alias(field) for name, field in OUTPUT_NAMES.items()])
    return (
        keep_rows(fixes, has_json_form())
        .withColumn("key", F.col("device_id"))
        .withColumn("value", F.to_json(message, {"timeZone": "UTC"}))
    )
