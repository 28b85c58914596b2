"""Timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackloom.functions.numbers import BLANKS, WHOLE_NUMBER

# The millisecond range in which a 64-bit nanosecond clock is defined.
MAX_EPOCH_MS = 9223372036854
# First and last millisecond of the years 1 to 9999.
FIRST_CALENDAR_MS = -62135596800000
LAST_CALENDAR_MS = 253402300799999
# Readable time format, and the accepted ISO timestamps.
READABLE = "yyyy-MM-dd HH:mm:ss"
ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?$"
)


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to timestamp; null outside the nanosecond clock's range."""
    in_range = ms.between(F.lit(-MAX_EPOCH_MS), F.lit(MAX_EPOCH_MS))
    return F.timestamp_millis(F.when(in_range, ms))


def readable_time(ms_text: Column) -> Column:
    """Epoch-millisecond text to ``yyyy-MM-dd HH:mm:ss`` in UTC; other text stays as it is."""
    bare = F.btrim(ms_text, F.lit(BLANKS))
    ms = F.when(bare.rlike(WHOLE_NUMBER), bare.try_cast("bigint"))
    shown = ms.between(F.lit(FIRST_CALENDAR_MS), F.lit(LAST_CALENDAR_MS))
    seconds = F.timestamp_millis(F.when(shown, ms))
    return F.coalesce(F.date_format(seconds, READABLE), ms_text)


def iso_timestamp(text: Column) -> Column:
    """``...Z`` to ``...+00:00`` with six fraction digits, or none when the fraction is zero.

    Text that is not a valid timestamp stays as it is.
    """
    whole = F.substring(text, 1, 19)
    rest = F.substring(text, F.lit(20), F.length(text))
    micros = F.rpad(F.regexp_extract(rest, r"^\.([0-9]{1,6})", 1), 6, "0")
    zone = (
        F.when(rest.endswith("Z"), "+00:00")
        .when(rest.rlike("[+-]"), F.right(rest, F.lit(6)))
        .otherwise("")
    )
    valid = text.rlike(ISO) & whole.try_cast("timestamp").isNotNull()
    fraction = F.concat(F.lit("."), micros)
    shown = F.when(micros == "000000", "").otherwise(fraction)
    return F.when(valid, F.concat(whole, shown, zone)).otherwise(text)


def add_seconds(ts: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
