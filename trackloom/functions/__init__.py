"""Column expressions. Everything here stays inside the JVM; there is no UDF."""

from trackloom.functions.geo import (
    haversine_m,
    latitude_shrink,
    mean_speed,
    micro_degrees,
    with_nearest_on_segment,
)
from trackloom.functions.numbers import (
    loose_float_ok,
    loose_int_ok,
    ratio_step,
    strict_double,
    strict_long,
)
from trackloom.functions.text import batch_key, empty_if_null, has_text, vehicle_key
from trackloom.functions.times import add_seconds, from_epoch_ms, iso_timestamp, readable_time

__all__ = [
    "add_seconds",
    "batch_key",
    "empty_if_null",
    "from_epoch_ms",
    "has_text",
    "haversine_m",
    "iso_timestamp",
    "latitude_shrink",
    "loose_float_ok",
    "loose_int_ok",
    "mean_speed",
    "micro_degrees",
    "ratio_step",
    "readable_time",
    "strict_double",
    "strict_long",
    "vehicle_key",
    "with_nearest_on_segment",
]
