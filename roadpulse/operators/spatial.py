"""Spatial joins as equi-joins on grid cells."""

from __future__ import annotations

from math import sin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.geo import EARTH_RADIUS, degrees_of_latitude, great_circle
from roadpulse.session import settle

# Keeps cells a little larger than the radius, against rounding.
_SLACK = 1.0001

# Band of points and of sites without coordinates; they never meet. With keys
# that cannot be NULL, no null check of them is pushed down, which would repeat
# the whole projection formula below every projection.
_NO_POINT, _NO_SITE = -(2**40), 2**40


def _band(lat: str, radius: float) -> str:
    return f"floor({lat} / {degrees_of_latitude(radius) * _SLACK!r}D)"


def _cells_around(band: str, radius: float) -> str:
    """How many equal cells circle the earth in a latitude band, each at least a radius wide.

    Two points within the radius, one of them in the band, have latitudes up to
    one band beyond it; the widest longitude difference follows from that.
    """
    step = degrees_of_latitude(radius) * _SLACK
    farthest = f"least(greatest(abs({band} - 1), abs({band} + 2)) * {step!r}D, 90D)"
    half = f"{sin(radius / EARTH_RADIUS / 2)!r}D / greatest(cos(radians({farthest})), 1e-12D)"
    width = f"degrees(2 * asin(least({half}, 1D))) * {_SLACK}D"
    return f"greatest(floor(360D / ({width})), 1L)"


def _cell(lon: str) -> str:
    return f"floor(({lon} + 180D) / 360D * _cells)"


def within_radius(points: DataFrame, sites: DataFrame, radius: float = 1000.0) -> DataFrame:
    """Each point with each site at most `radius` metres away, and their `distance`.

    Both sides hold lat and lon in degrees; the other columns must not clash.
    Sites, the smaller side, are entered into their own and the eight
    neighbouring cells, so each pair meets exactly once, in the point's cell.
    """
    neighbours = ", ".join(f"coalesce(pmod(_own + {k}, _cells), -1L)" for k in (-1, 0, 1))
    near = (
        sites.withColumnsRenamed({"lat": "site_lat", "lon": "site_lon"})
        .withColumn("_band", F.expr(f"coalesce({_band('site_lat', radius)}, {_NO_SITE}L)"))
        .withColumn("_band", F.expr("explode(array(_band - 1, _band, _band + 1))"))
        .withColumn("_cells", F.expr(_cells_around("_band", radius)))
        .withColumn("_own", F.expr(_cell("site_lon")))
        .withColumn("_cell", F.expr(f"explode(array_distinct(array({neighbours})))"))
        .drop("_cells", "_own")
    )
    # The points of a hot cell are one skewed partition, which AQE splits.
    placed = (
        points.withColumn("_band", F.expr(f"coalesce({_band('lat', radius)}, {_NO_POINT}L)"))
        .withColumn("_cells", F.expr(_cells_around("_band", radius)))
        .withColumn("_cell", F.expr(f"coalesce(pmod({_cell('lon')}, _cells), -2L)"))
        .drop("_cells")
    )
    return (placed.join(near, ["_band", "_cell"])
            .withColumn("distance", great_circle("lat", "lon", "site_lat", "site_lon"))
            .where(F.col("distance") <= radius)
            .drop("_band", "_cell", "site_lat", "site_lon"))


def _square(c: Column) -> Column:
    return c * c


# Nodes per cell up to which it is not divided further, and the levels, each of
# eight by eight parts, that a cell can be divided by.
LEAF_NODES, LEVELS = 16, 10


def nearest_node(points: DataFrame, nodes: DataFrame, leaf: int = LEAF_NODES) -> DataFrame:
    """Each point (x, y, ...) with node_id and distance of its nearest node.

    Ties go to the smaller id. The nodes' extent is divided by eight along each
    axis, level by level, as long as a cell holds more than `leaf` nodes, so
    dense places are divided further than others. Every point descends from the
    single top cell; at each level it keeps the cells whose nearest possible node
    is no farther than the nearest node known so far, which is exact and leaves a
    few cells per point however the nodes are clustered.
    """
    nodes = settle(nodes.where(F.col("x").isNotNull() & F.col("y").isNotNull())
                   .groupBy("x", "y").agg(F.min("node_id").alias("node_id")), "places")
    extent = nodes.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if extent[0] is None:
        return points.withColumns({"node_id": F.lit(None).cast("bigint"),
                                   "distance": F.lit(None).cast("double")})
    left, right, bottom, top = extent
    side = max(right - left, top - bottom) or 1.0
    parts = 8 ** LEVELS

    def index(value: Column, origin: float) -> Column:
        return F.least(F.floor((value - origin) / side * parts), F.lit(parts - 1))

    def by_level(level: Column) -> DataFrame:
        return nodes.withColumn("level", F.explode(level)).withColumns({
            "cx": F.expr("shiftright(ix, 3 * (%d - level))" % LEVELS),
            "cy": F.expr("shiftright(iy, 3 * (%d - level))" % LEVELS)}).drop("ix", "iy")

    nodes = nodes.withColumns({"ix": index(F.col("x"), left), "iy": index(F.col("y"), bottom)})
    tree = settle(
        by_level(F.sequence(F.lit(1), F.lit(LEVELS))).groupBy("level", "cx", "cy")
        .agg(F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
             F.min("y").alias("y0"), F.max("y").alias("y1"),
             F.min(F.struct("x", "y")).alias("some")), "cells")
    # One number: the last level at which a cell is divided.
    depth = min(LEVELS, (tree.where(F.col("n") > leaf).agg(F.max("level")).first()[0] or 0) + 1)

    px, py = F.col("px"), F.col("py")
    per_point = Window.partitionBy("px", "py")
    zero = F.lit(0).cast("bigint")
    frontier = (points.select(F.col("x").alias("px"), F.col("y").alias("py"))
                .where(F.col("x").isNotNull() & F.col("y").isNotNull()).distinct()
                .withColumns({"px_cell": zero, "py_cell": zero, "known": F.lit(float("inf"))}))
    ends = []
    for level in range(1, depth + 1):
        cells = (tree.where(F.col("level") == level)
                 .withColumns({"px_cell": F.shiftright("cx", 3), "py_cell": F.shiftright("cy", 3)}))
        if level <= 2:
            # At most 64 and 4096 cells, which all points would otherwise be sent to.
            cells = F.broadcast(cells)
        gap_x = F.greatest(F.col("x0") - px, px - F.col("x1"), F.lit(0.0))
        gap_y = F.greatest(F.col("y0") - py, py - F.col("y1"), F.lit(0.0))
        reached = _square(F.col("some.x") - px) + _square(F.col("some.y") - py)
        kept = (frontier.join(cells, ["px_cell", "py_cell"])
                .withColumns({"near": _square(gap_x) + _square(gap_y), "reached": reached})
                .withColumn("known", F.least("known", F.min("reached").over(per_point)))
                .where(F.col("near") <= F.col("known"))
                .select("px", "py", "cx", "cy", "n", "known"))
        kept = settle(kept, "frontier")
        end = kept if level == depth else kept.where(F.col("n") <= leaf)
        ends.append(end.select("px", "py", F.lit(level).alias("level"), "cx", "cy"))
        frontier = kept.where(F.col("n") > leaf).select(
            "px", "py", F.col("cx").alias("px_cell"), F.col("cy").alias("py_cell"), "known")
    reached_cells = ends[0]
    for end in ends[1:]:
        reached_cells = reached_cells.union(end)
    distance = _square(F.col("x") - px) + _square(F.col("y") - py)
    found = (reached_cells.join(by_level(F.sequence(F.lit(1), F.lit(depth))), ["level", "cx", "cy"])
             .groupBy("px", "py")
             .agg(F.min(F.struct(distance.alias("d"), F.col("node_id"))).alias("hit"))
             .select("px", "py", F.col("hit.node_id").alias("node_id"),
                     F.sqrt("hit.d").alias("distance")))
    return (points.join(found, (F.col("x") == px) & (F.col("y") == py), "left")
            .drop("px", "py"))
