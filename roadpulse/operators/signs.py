"""From anomalies to messages for the traffic boards nearby."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geo import with_latlon
from roadpulse.functions.messages import json_fields, once, sign_text, to_id
from roadpulse.operators.spatial import within_radius

RADIUS_METRES = 1000.0
# Fixed value: the routing key sign messages are published under.
SIGN_ROUTING_KEY = "#"


def parse_anomalies(messages: DataFrame, value: str = "value") -> DataFrame:
    """Anomaly messages -> value, edge_id (NULL where malformed)."""
    return (messages.select(F.col(value).alias("value"), json_fields(["edgeId"], value))
            .select("value", to_id(F.col("edgeId")).alias("edge_id")))


def locate_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edge_id, from_node, to_node, node_known (NULL if the map lacks the from node); node ids are unique."""
    known = nodes.select(F.col("node_id").alias("from_node"), F.lit(True).alias("node_known"))
    return edges.select("edge_id", "from_node", "to_node").join(known, "from_node", "left")


def boards_near(edges: DataFrame, nodes: DataFrame, boards: DataFrame,
                radius: float = RADIUS_METRES) -> DataFrame:
    """from_node, board, distance for each node that starts an edge.

    The geometry is done once per node, not per anomaly.
    """
    starts = edges.select(F.col("from_node").alias("node_id")).distinct()
    placed = with_latlon(nodes.join(starts, "node_id", "left_semi")).select(
        F.col("node_id").alias("from_node"), "lat", "lon")
    sites = boards.select(F.col("description").alias("board"), "lat", "lon")
    return within_radius(placed, sites, radius).select("from_node", "board", "distance")


def _with_reason(found: DataFrame, located: DataFrame) -> DataFrame:
    """Anomalies with their edge's nodes and, where that fails, a `reason`."""
    reason = (F.when(F.col("edge_id").isNull(), "no edge id")
              .when(F.col("from_node").isNull(), "unknown edge")
              .when(F.col("node_known").isNull(), "unknown node"))
    return found.join(located, "edge_id", "left").withColumn("reason", reason)


def sign_rows(found: DataFrame, located: DataFrame, near: DataFrame,
              strict: bool = True) -> DataFrame:
    """edge_id, routing_key, body from the results of `locate_edges` and `boards_near`."""
    judged = _with_reason(found, located)
    if strict:
        complaint = F.raise_error(F.concat(
            F.col("reason"), F.lit(": "), F.coalesce(F.col("edge_id").cast("string"), F.lit(""))))
        judged = judged.withColumn("from_node", F.when(
            F.col("reason").isNull(), F.col("from_node")).otherwise(complaint.cast("bigint")))
        near = near.withColumn("board", F.coalesce(
            F.col("board"), F.raise_error(F.lit("board without description")).cast("string")))
    else:
        judged = judged.where(F.col("reason").isNull())
        near = near.where(F.col("board").isNotNull())
    # The outer join and `once` see to it that every anomaly is judged, even
    # where no board is near.
    return (judged.join(near, "from_node", "left")
            .select(once("edge_id", "from_node", "to_node", "board"))
            .where(F.col("board").isNotNull())
            .select("edge_id", F.lit(SIGN_ROUTING_KEY).alias("routing_key"),
                    sign_text(F.col("board"), F.col("from_node"), F.col("to_node")).alias("body")))


def sign_messages(found: DataFrame, edges: DataFrame, nodes: DataFrame, boards: DataFrame,
                  radius: float = RADIUS_METRES, strict: bool = True) -> DataFrame:
    """edge_id, routing_key, body: one message per anomaly and board near the edge's start.

    `found` holds edge_id. Strict mode fails on an anomaly without a known edge
    and node and on a board without a description; otherwise such rows are left
    out here and `rejected_anomalies` lists them.
    """
    edges = edges.join(found.select("edge_id"), "edge_id", "left_semi")
    return sign_rows(found, locate_edges(edges, nodes),
                     boards_near(edges, nodes, boards, radius), strict)


def rejected_boards(boards: DataFrame) -> DataFrame:
    """The boards that no sign message can name or place, with the reason."""
    reason = (F.when(F.col("description").isNull(), "board without description")
              .when(F.col("lat").isNull() | F.col("lon").isNull(), "board without place"))
    return (boards.select(once(*boards.columns)).withColumn("reason", reason)
            .where(F.col("reason").isNotNull()))


def rejected_anomalies(found: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The columns of unusable anomalies, with the reason."""
    return (_with_reason(found, locate_edges(edges, nodes)).where(F.col("reason").isNotNull())
            .drop("from_node", "to_node", "node_known"))
