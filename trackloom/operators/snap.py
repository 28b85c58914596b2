"""Nearest-road lookup as equi-joins on a grid.

The nearest position depends only on the six-decimal coordinate, so the search runs
once per distinct coordinate: copies of one coordinate (parked vehicles) collapse
before any shuffle, and a finest grid cell holds at most 2**18 coordinates however
many fixes fall into it.

The grid is a pyramid of cells of 2**9, 2**10, ... micro-degrees, so a cell's parent
is a bit shift away. For each finest cell with coordinates:

1. find its smallest ancestor that holds a point of some road. That road is at most
   the ancestor's diagonal away from every coordinate in the cell, which bounds the
   search exactly. The coarsest cell holds the whole world, so only an empty road table
   leaves a coordinate without a bound.
2. take the ancestor-level cells within that bound. Where they are large (coordinates
   far from any road) go down the pyramid, some levels at a time, and keep the cells
   that are not further away than another one certainly is at its far corner.
3. fetch the segments registered in these cells, and keep those that can still win: at
   most the cell's diagonal further from its centre than the segment nearest to it.

Then coordinates meet the segments of their own cell, and the nearest wins. No step
compares all points with all roads, and none limits the number of candidates.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.geo import (
    METRES_PER_DEGREE,
    MICRO,
    latitude_shrink,
    micro_degrees,
    with_nearest_on_segment,
)

CELL_BITS = 9
CELL = 1 << CELL_BITS
CELL_METRES = CELL / MICRO * METRES_PER_DEGREE
# Cells are counted from here, west and south of every coordinate, so that all have a common ancestor.
ORIGIN = 1 << 29
# The level with one cell for the whole world.
TOP = 21
# The search narrows down to cells of level 1 before it looks at segments.
NARROW_TO = 1
NARROW_STEP = 5
# A search looks at about this many cells from west to east; near the poles it does so at a coarser level.
ACROSS = 32
# A stored index keeps cells up to this level in one folder for each of its cells, a degree wide; the few above lie in one.
TILE_LEVEL = 11
TILES_ACROSS = 1 << 10
COARSE = -1
# Room for rounding in the search bounds; it only adds candidates.
SLACK = 1.001
# Larger than any segment id, for ranks of distance and id.
ID_SPAN = Decimal(1 << 64)


def _cell(micro: Column, level: Column | None = None) -> Column:
    """Cell number of a coordinate in micro-degrees."""
    whole = F.floor(micro).cast("bigint") + F.lit(ORIGIN)
    finest = F.shiftright(whole, CELL_BITS)
    return finest if level is None else F.call_function("shiftright", finest, level)


def _tile(level: Column) -> Column:
    """The tile that the cell (level, gx, gy) lies in."""
    rise = F.greatest(F.lit(TILE_LEVEL) - level, F.lit(0))
    number = _up("gx", rise) * TILES_ACROSS + _up("gy", rise)
    return F.when(level > TILE_LEVEL, F.lit(COARSE)).otherwise(number).cast("int")


@dataclass(frozen=True)
class RoadIndex:
    """Roads laid out on the grid; build it once and keep it as tables for repeated use.

    ``segments``: (level, gx, gy) with the segments that may pass through the cell, for
    the levels at which segments are searched.
    ``cells``: (level, gx, gy) of such cells on all levels; ``sure`` where a point of a
    road is inside.
    """

    cells: DataFrame
    segments: DataFrame
    # Both tables have the partition column ``tile``.
    tiled: bool = False

    @classmethod
    def build(cls, roads: DataFrame) -> RoadIndex:
        searched = NARROW_TO
        segment = ["seg_id", "x1", "y1", "x2", "y2"]
        # Copies of one geometry are equally near everywhere, so the smallest id stands for all.
        roads = roads.groupBy("x1", "y1", "x2", "y2").agg(F.min("seg_id").alias("seg_id"))
        mx1, my1 = F.col("x1") * MICRO, F.col("y1") * MICRO
        span_x, span_y = (F.col("x2") - F.col("x1")) * MICRO, (F.col("y2") - F.col("y1")) * MICRO
        longest = F.greatest(F.abs(span_x), F.abs(span_y))

        # A segment is cut into pieces no longer than a cell, so that it is registered
        # along its line and not in its whole bounding box.
        steps = F.greatest(F.ceil(longest / F.lit(CELL)), F.lit(1)).cast("int")
        occupied = (
            roads.select(mx1.alias("mx"), my1.alias("my"), span_x.alias("sx"), span_y.alias("sy"), steps.alias("n"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("k"))
            .select(
                _cell(F.col("mx") + F.col("sx") * F.col("k") / F.col("n")).alias("gx"),
                _cell(F.col("my") + F.col("sy") * F.col("k") / F.col("n")).alias("gy"),
            )
            .distinct()
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(TOP))).alias("level"))
            .select(
                "level",
                F.call_function("shiftright", F.col("gx"), F.col("level")).alias("gx"),
                F.call_function("shiftright", F.col("gy"), F.col("level")).alias("gy"),
            )
            .distinct()
        )

        size = F.call_function("shiftleft", F.lit(CELL), F.col("level"))
        pieces = F.greatest(F.ceil(longest / size), F.lit(1)).cast("int")

        def edge(start: Column, span: Column, k: Column) -> Column:
            return start + span * k / F.col("n")

        k = F.col("k")
        xa, xb = edge(mx1, span_x, k), edge(mx1, span_x, k + 1)
        ya, yb = edge(my1, span_y, k), edge(my1, span_y, k + 1)
        level = F.col("level")
        segments = (
            roads.select(*segment)
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(searched))).alias("level"))
            .select("*", pieces.alias("n"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
            .select(
                "*",
                F.explode(
                    F.sequence(_cell(F.least(xa, xb), level), _cell(F.greatest(xa, xb), level))
                ).alias("gx"),
            )
            .select(
                "*",
                F.explode(
                    F.sequence(_cell(F.least(ya, yb), level), _cell(F.greatest(ya, yb), level))
                ).alias("gy"),
            )
            .select("level", "gx", "gy", *segment)
        )
        crossed = segments.select("level", "gx", "gy").distinct()
        rise = F.col("_rise")
        above = (
            crossed.filter(level == searched)
            .select("*", F.explode(F.sequence(F.lit(1), F.lit(TOP - searched))).alias("_rise"))
            .select((level + rise).alias("level"), _up("gx", rise).alias("gx"), _up("gy", rise).alias("gy"))
        )
        crossed = crossed.unionByName(above)
        cells = (
            crossed.withColumn("sure", F.lit(False))
            .unionByName(occupied.withColumn("sure", F.lit(True)))
            .groupBy("level", "gx", "gy")
            .agg(F.max("sure").alias("sure"))
        )
        return cls(cells, segments)

    def persist(self) -> RoadIndex:
        """Keep the index in the cluster for repeated use; lost parts are computed again."""
        return RoadIndex(self.cells.persist(), self.segments.persist())

    def unpersist(self) -> None:
        self.cells.unpersist()
        self.segments.unpersist()

    def write(self, path: str) -> None:
        """Keep the index as two Parquet tables, a folder for each tile, ordered by cell within."""
        for name, table in (("cells", self.cells), ("segments", self.segments)):
            placed = table.drop("tile").withColumn("tile", _tile(F.col("level")))
            ordered = placed.repartitionByRange("tile", "level", "gx", "gy")
            ordered = ordered.sortWithinPartitions("tile", "level", "gx", "gy")
            ordered.write.mode("overwrite").partitionBy("tile").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> RoadIndex:
        return cls(spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/segments"), tiled=True)

    def of_tiles(self, tiles: set[int]) -> RoadIndex:
        wanted = F.col("tile").isin(sorted(tiles))
        return RoadIndex(self.cells.filter(wanted), self.segments.filter(wanted), tiled=True)

    def around(self, points: DataFrame, max_radius_m: float | None = None) -> RoadIndex:
        """The part of a stored index that the search for these points can touch: other tiles' files are not read.

        Two short jobs find it, first the tiles of the points and then those that their search bounds reach. What crosses to
        the driver are tile numbers, a million on all the world. Points with no road in their tile need the whole index.
        """
        if not self.tiled:
            return self
        micro = [micro_degrees(F.col(name)) for name in ("longitude", "latitude")]
        on_map = (F.abs("longitude") <= 180) & (F.abs("latitude") <= 90)
        cells = points.filter(on_map).select(_cell(micro[0]).alias("cx"), _cell(micro[1]).alias("cy")).distinct()
        own = cells.select(_up("cx", F.lit(TILE_LEVEL)).alias("gx"), _up("cy", F.lit(TILE_LEVEL)).alias("gy")).distinct()
        here = self.of_tiles({COARSE} | {r["tile"] for r in own.select(_tile(F.lit(TILE_LEVEL)).alias("tile")).collect()})
        # the level to search at depends on a cell's own ancestors, all of which lie in its tile or above
        areas = _search_areas(cells, here, max_radius_m)
        reached = {r["tile"] for r in areas.select(_tile(F.col("level")).alias("tile")).distinct().collect()}
        return self if COARSE in reached else self.of_tiles(reached | {COARSE})


def _search_areas(cells: DataFrame, index: RoadIndex, max_radius_m: float | None) -> DataFrame:
    """For each finest cell: the level to search at and the cells of that level to look into."""
    level = F.col("level")
    occupied = index.cells.filter("sure").select("level", "gx", "gy")
    # An inner join: the few cells in question can be sent to the index, whatever its size.
    nearest_level = (
        cells.select("cx", "cy", F.explode(F.sequence(F.lit(0), F.lit(TOP))).alias("level"))
        .select("cx", "cy", "level", _up("cx", level).alias("gx"), _up("cy", level).alias("gy"))
        .join(occupied, ["level", "gx", "gy"])
        .groupBy("cx", "cy")
        .agg(F.min("level").alias("level"))
        .withColumn("_shrink", F.coalesce(latitude_shrink(_centre("cy")), F.lit(1.0)))
    )
    diagonal = (
        F.lit(CELL_METRES)
        * F.call_function("shiftleft", F.lit(1), level)
        * F.sqrt(1 + F.pow(_widest(), F.lit(2.0)))
    )
    # The search bound in metres, and in micro-degrees north-south and east-west, at most once round the world.
    bound = (diagonal if max_radius_m is None else F.least(diagonal, F.lit(float(max_radius_m)))) * SLACK
    world = F.lit(float(ORIGIN))
    span_y = F.least(F.col("_reach") * (MICRO / METRES_PER_DEGREE) + 1, world)
    span_x = F.least(span_y / _narrowest(), world)
    low_x, low_y = F.col("cx") * CELL - ORIGIN, F.col("cy") * CELL - ORIGIN
    coarse = F.ceil(F.log2(F.greatest(2 * span_x / (ACROSS * CELL), F.lit(1.0)))).cast("int")

    def covered(low: Column, span: Column) -> Column:
        return F.explode(F.sequence(_cell(low - span, level), _cell(low + CELL + span, level)))

    own = ["cx", "cy", "level", "_shrink", "_reach"]
    return (
        nearest_level.withColumn("_reach", bound)
        .withColumn("level", F.greatest(level, F.least(coarse, F.lit(TOP))))
        .select(*own, covered(low_x, span_x).alias("gx"))
        .select(*own, "gx", covered(low_y, span_y).alias("gy"))
    )


def _centre(cell: str) -> Column:
    """Middle of a finest cell in degrees."""
    return (F.col(cell) * CELL - ORIGIN + CELL / 2) / MICRO


def _up(cell: str, level: Column) -> Column:
    return F.call_function("shiftright", F.col(cell), level)


def _widest() -> Column:
    """Largest east-west scale in a finest cell; the smallest is ``_narrowest``."""
    return F.least(F.col("_shrink") + 1e-5, F.lit(1.0))


def _narrowest() -> Column:
    return F.greatest(F.col("_shrink") - 1e-5, F.lit(1e-5))


def _narrow(areas: DataFrame, index: RoadIndex, target: int) -> DataFrame:
    """Replace large cells by those of their parts at level ``target`` that can hold the nearest road."""
    size = CELL << target
    parts = index.cells.filter(F.col("level") == target).select(
        F.col("gx").alias("px"),
        F.col("gy").alias("py"),
        "sure",
        F.explode(F.sequence(F.lit(1), F.lit(NARROW_STEP))).alias("_rise"),
    )
    parts = parts.select(
        "px",
        "py",
        "sure",
        (F.col("_rise") + target).alias("level"),
        _up("px", F.col("_rise")).alias("gx"),
        _up("py", F.col("_rise")).alias("gy"),
    )

    def least_gap(own: str, part: str) -> Column:
        low, other = F.col(own) * CELL, F.col(part) * size
        return F.greatest(other - low - CELL, low - other - size, F.lit(0))

    def most_gap(own: str, part: str) -> Column:
        low, other = F.col(own) * CELL, F.col(part) * size
        return F.greatest(other + size - low, low + CELL - other)

    def metres(x: Column, y: Column, scale: Column) -> Column:
        squares = F.pow(x * scale, F.lit(2.0)) + F.pow(y.cast("double"), F.lit(2.0))
        return F.sqrt(squares) * (METRES_PER_DEGREE / MICRO)

    nearest = metres(least_gap("cx", "px"), least_gap("cy", "py"), _narrowest())
    farthest = metres(most_gap("cx", "px"), most_gap("cy", "py"), _widest())
    met = areas.join(parts, ["level", "gx", "gy"]).select(
        "cx",
        "cy",
        "_shrink",
        "_reach",
        "px",
        "py",
        nearest.alias("_nearest"),
        F.when(F.col("sure"), farthest * SLACK).alias("_farthest"),
    )
    certain = F.min("_farthest").over(Window.partitionBy("cx", "cy"))
    return (
        met.filter(F.col("_nearest") <= F.col("_reach"))
        .withColumn("_reach", F.least("_reach", certain))
        .filter(F.col("_nearest") <= F.col("_reach"))
        .select(
            "cx",
            "cy",
            F.lit(target).alias("level"),
            "_shrink",
            "_reach",
            F.col("px").alias("gx"),
            F.col("py").alias("gy"),
        )
    )


def _narrowed_areas(cells: DataFrame, index: RoadIndex, max_radius_m: float | None) -> DataFrame:
    areas = _search_areas(cells, index, max_radius_m)
    result = areas.filter(F.col("level") <= NARROW_TO)
    carried = None
    for target in reversed(range(NARROW_TO, TOP, NARROW_STEP)):
        above = areas.filter(F.col("level").between(target + 1, target + NARROW_STEP))
        carried = _narrow(above if carried is None else above.unionByName(carried), index, target)
    return result if carried is None else result.unionByName(carried)


def road_candidates(cells: DataFrame, index: RoadIndex, max_radius_m: float | None = None) -> DataFrame:
    """For each finest cell ``(cx, cy)`` every segment that can be nearest to a point in it."""
    diagonal = CELL_METRES * 1.41422
    met = _narrowed_areas(cells, index, max_radius_m).join(index.segments, ["level", "gx", "gy"])
    return (
        met.transform(with_nearest_on_segment, _centre("cx"), _centre("cy"), F.col("_shrink"))
        .filter(F.col("hit_m") <= (F.col("_reach") + diagonal / 2) * SLACK)
        .select("cx", "cy", "seg_id", "x1", "y1", "x2", "y2", "hit_m")
        # A segment met through several cells counts once.
        .distinct()
        .withColumn("_nearest", F.min("hit_m").over(Window.partitionBy("cx", "cy")))
        .filter(F.col("hit_m") <= (F.col("_nearest") + diagonal) * SLACK)
        .select("cx", "cy", "seg_id", "x1", "y1", "x2", "y2")
    )


def nearest_road(coordinates: DataFrame, index: RoadIndex, max_radius_m: float | None = None) -> DataFrame:
    """Nearest road position of each distinct micro-degree coordinate ``(mlon, mlat)``.

    Ties in distance, taken in micrometres, go to the smaller ``seg_id``. Coordinates
    with no road within the radius, if one is given, are left out.
    """
    # Columns that cannot be null keep the branches of the search alike, so that Spark
    # computes what they share once.
    placed = coordinates.select(
        "mlon",
        "mlat",
        F.coalesce(_cell(F.col("mlon")), F.lit(0)).alias("cx"),
        F.coalesce(_cell(F.col("mlat")), F.lit(0)).alias("cy"),
        (F.col("mlon") / MICRO).alias("_lon"),
        (F.col("mlat") / MICRO).alias("_lat"),
    ).withColumn("_shrink", latitude_shrink(F.col("_lat")))
    candidates = road_candidates(placed.select("cx", "cy").distinct(), index, max_radius_m)
    # Distance and id in one wide number: a plain hash aggregate then finds the nearest
    # segment, where a struct would force a sort of all candidates.
    micrometres = F.floor(F.col("hit_m") * MICRO + 0.5).cast("decimal(17,0)")
    rank = micrometres * F.lit(ID_SPAN) + F.col("seg_id").cast("decimal(20,0)")
    found = (
        placed.join(candidates, ["cx", "cy"])
        .transform(with_nearest_on_segment, F.col("_lon"), F.col("_lat"), F.col("_shrink"))
        .withColumn("_rank", rank)
        .groupBy("cx", "cy", "mlon", "mlat")
        .agg(
            F.min_by("seg_id", "_rank").alias("seg_id"),
            F.min_by("hit_lon", "_rank").alias("road_lon"),
            F.min_by("hit_lat", "_rank").alias("road_lat"),
            F.min_by("hit_m", "_rank").alias("road_metres"),
        )
    )
    if max_radius_m is not None:
        found = found.filter(F.col("road_metres") <= max_radius_m)
    return found.select("mlon", "mlat", "seg_id", "road_lon", "road_lat", "road_metres")


def snap_to_road(
    points: DataFrame,
    roads: DataFrame | RoadIndex,
    max_radius_m: float | None = None,
    keep_hit: bool = False,
) -> DataFrame:
    """Move each point to the nearest road, however far; other columns stay as they are.

    With ``max_radius_m`` points further from every road stay where they are.
    ``keep_hit`` adds ``seg_id`` and ``road_metres`` (null where no road was found).
    """
    index = roads if isinstance(roads, RoadIndex) else RoadIndex.build(roads)
    # NaN and far-out coordinates get a null key: they find no road and stay as they are.
    on_map = (F.abs("longitude") <= 180) & (F.abs("latitude") <= 90)
    micro = {"mlon": micro_degrees(F.col("longitude")), "mlat": micro_degrees(F.col("latitude"))}
    coordinates = points.filter(on_map).select(
        *[column.alias(name) for name, column in micro.items()]
    )
    found = nearest_road(coordinates.distinct(), index, max_radius_m)
    moved = {
        "latitude": F.coalesce("road_lat", "latitude").alias("latitude"),
        "longitude": F.coalesce("road_lon", "longitude").alias("longitude"),
    }
    extra = ["seg_id", "road_metres"] if keep_hit else []
    return (
        points.withColumns({name: F.when(on_map, column) for name, column in micro.items()})
        .join(found, ["mlon", "mlat"], "left")
        .select(*[moved.get(name, F.col(name)) for name in points.columns], *extra)
    )
