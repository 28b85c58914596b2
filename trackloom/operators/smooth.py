"""The full smoothing of tracks: snap every fix, fill every gap."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators.decode import with_failed_unit
from trackloom.operators.routes import (
    NO_ROUTE,
    append_imputed,
    fill_gaps,
    find_gaps,
    route_lookup,
)
from trackloom.operators.slices import with_next
from trackloom.operators.snap import RoadIndex, snap_to_road
from trackloom.operators.track import GAP_METRES, ORDER, UNIT
from trackloom.operators.units import split_by_units
from trackloom.schemas import FIX_COLUMNS


def smooth(points: DataFrame, roads: DataFrame | RoadIndex, routes: DataFrame, *args: Any, **options: Any) -> DataFrame:
    """Snapped fixes and inserted route points of every unit; see ``smooth_or_reject``."""
    return smooth_or_reject(points, roads, routes, *args, **options)[0]


def smooth_or_reject(
    points: DataFrame,
    roads: DataFrame | RoadIndex,
    routes: DataFrame,
    unit: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    width: int | None = None,
    max_radius_m: float | None = None,
    gap_metres: float = GAP_METRES,
    on_missing_route: str = "drop_unit",
    bounded: bool = False,
    unique_routes: bool = False,
    max_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Snapped fixes and inserted route points, and the fixes of units that were set aside with ``error``.

    * Gaps and route ends use the original coordinates, not the snapped ones.
    * A unit of one fix is returned unchanged.
    * ``drop_unit``: a gap without a route removes its whole unit. ``keep_gap``: such a
      gap stays open.

    ``bounded`` says that a unit has a bounded number of rows (message batches); ``max_rows`` bounds the rows of
    a unit that one window sees, for units of any size.

    The output has the fix columns, the unit columns, the order columns as
    ``after_<name>`` and ``j``: 0 for a fix, else the place on the route after it.
    ``output_order`` on ``after_<name>`` puts it in sequence. The rejected fixes have the same
    columns, with their original coordinates.
    """
    if on_missing_route not in ("drop_unit", "keep_gap"):
        raise ValueError(f"on_missing_route must be drop_unit or keep_gap, not {on_missing_route!r}")
    unit, order = list(unit), list(order)
    after = {f"after_{name}": F.col(name) for name in order}
    columns = list(dict.fromkeys([*unit, *after, "j", *FIX_COLUMNS]))

    keyed = points.withColumns(after)
    marked = with_next(keyed, unit, order, ["latitude", "longitude", "speed"], width, bounded, max_rows)

    original = marked.withColumn("_lat", F.col("latitude")).withColumn("_lon", F.col("longitude"))
    snapped = snap_to_road(original, roads, max_radius_m)
    fixes = (
        snapped.withColumn("latitude", F.when(F.col("alone"), F.col("_lat")).otherwise(F.col("latitude")))
        .withColumn("longitude", F.when(F.col("alone"), F.col("_lon")).otherwise(F.col("longitude")))
        .withColumn("j", F.lit(0))
    )

    routed = route_lookup(find_gaps(marked.drop("alone"), gap_metres), routes, unique_routes)
    back = [
        F.col({"latitude": "_lat", "longitude": "_lon"}.get(name, name)).alias(name) for name in columns
    ]
    if on_missing_route == "keep_gap":
        nothing = fixes.select(*back, F.lit(NO_ROUTE).alias("error")).limit(0)
        return append_imputed(fixes.select(*columns), fill_gaps(routed).select(*columns)), nothing
    if not bounded:
        failed = routed.filter(F.col("error").isNotNull()).select(*unit).distinct()
        kept, lost = split_by_units(fixes, failed, unit)
        inserted, _ = split_by_units(fill_gaps(routed).select(*columns), failed, unit)
        return append_imputed(kept.select(*columns), inserted), lost.select(*back, F.lit(NO_ROUTE).alias("error"))

    # Fixes and gaps meet in one window over the unit, which carries the failure to both.
    names = list(dict.fromkeys([*columns, "next"]))
    rows = fixes.select(*names, "_lat", "_lon", F.lit(None).cast(routed.schema["coordinates"].dataType).alias("coordinates"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("_fix"))
    gaps = routed.select(
        *[F.lit(0).alias("j") if name == "j" else F.col(name) for name in names],
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
        "coordinates",
        "error",
        F.lit(False).alias("_fix"),
    )
    together = with_failed_unit(rows.unionByName(gaps), F.col("error").isNotNull(), unit)
    kept = together.filter(~F.col("_failed"))
    inserted = fill_gaps(kept.filter(~F.col("_fix")).drop("j", "_lat", "_lon", "_fix", "_failed"))
    lost = together.filter(F.col("_failed") & F.col("_fix")).select(*back, F.lit(NO_ROUTE).alias("error"))
    return append_imputed(kept.filter("_fix").select(*columns), inserted.select(*columns)), lost
