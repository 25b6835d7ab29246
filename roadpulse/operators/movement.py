"""From position histories to speeds per road edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.messages import to_id
from roadpulse.operators.lookup import split_rejects

# A vehicle's history is cut into slices of 2^20 ticks. A slice holds one row per
# tick at most, so no task ever orders more than that many rows of one vehicle.
SLICE_BITS = 20


def flatten_histories(histories: DataFrame) -> DataFrame:
    """One row per recorded point: uuid, date, tick and edge id as numbers."""
    return (histories
            .select("uuid", F.explode("capabilities.current_location").alias("point"))
            .select("uuid", F.col("point.date").alias("date"),
                    to_id(F.col("point.tick")).alias("tick"),
                    F.col("point.nodeID").try_cast("bigint").alias("edge_id")))


#: Why a point may be unusable, by the column it lacks; the first that applies counts.
REJECTED = {"uuid": "no uuid", "tick": "no tick", "edge_id": "no edge"}


def _reason():
    out = F
    for column, reason in REJECTED.items():
        out = out.when(F.col(column).isNull(), reason)
    return out


def judged_positions(points: DataFrame) -> DataFrame:
    """The points with the `reason` to reject them, if any."""
    return points.withColumn("reason", _reason())


def clean_positions(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uuid, tick, edge_id rows usable for speeds, rejected rows with a reason)."""
    good, bad = split_rejects(points, _reason())
    return good.select("uuid", "tick", "edge_id"), bad


def moves(positions: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """uuid, tick, edge_id, tick_diff: each advance of a vehicle to its next point.

    Points are ordered by (tick, edge_id) and the reached point names the edge.
    Of several points in one tick only the first has a predecessor at an earlier
    tick, so they combine to one row beforehand. A vehicle's history is cut into
    slices; the last tick of a slice is carried into the vehicle's next one.
    """
    points = (positions.groupBy("uuid", F.col("tick").cast("bigint").alias("tick"))
              .agg(F.min("edge_id").alias("edge_id"))
              .withColumn("slice", F.shiftright("tick", slice_bits)))
    by_slice = Window.partitionBy("uuid").orderBy("slice")
    # A carried row's edge is never used; naming one lets both uses of `points`
    # share a shuffle.
    carried = (points.groupBy("uuid", "slice")
               .agg(F.max("tick").alias("last"), F.max("edge_id").alias("edge_id"))
               .select("uuid", "slice", F.lag("last").over(by_slice).alias("tick"), "edge_id",
                       F.lit(True).alias("carried"))
               .where(F.col("tick").isNotNull()))
    rows = points.withColumn("carried", F.lit(False)).unionByName(carried)
    previous = F.lag("tick").over(Window.partitionBy("uuid", "slice").orderBy("tick"))
    return (rows.withColumn("tick_diff", F.col("tick") - previous)
            .where(~F.col("carried") & (F.col("tick_diff") > 0))
            .select("uuid", "tick", "edge_id", "tick_diff"))


def edge_speeds(positions: DataFrame, edges: DataFrame) -> DataFrame:
    """Every move with the edge's length and the speed in length per tick.

    An unknown edge keeps its row, with NULL length and speed.
    """
    return (moves(positions).join(edges.select("edge_id", "length"), "edge_id", "left")
            .withColumn("kmh", F.col("length") / F.col("tick_diff"))
            .select("uuid", "tick", "edge_id", "length", "tick_diff", "kmh"))


def speed_counts(positions: DataFrame, edges: DataFrame) -> DataFrame:
    """edge_id, value, n: how often each speed occurs on each edge.

    Length is constant on an edge, so moves are counted by (edge, tick
    difference) first and only those counts meet the edge table.
    """
    counted = (moves(positions).groupBy("edge_id", "tick_diff")
               .agg(F.count(F.lit(1)).alias("n")))
    return (counted.join(edges.select("edge_id", "length"), "edge_id", "left")
            .select("edge_id", (F.col("length") / F.col("tick_diff")).alias("value"), "n"))
