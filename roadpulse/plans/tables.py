"""The given tables seen as traffic data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.geo import with_latlon
from roadpulse.operators import catalog


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _edge_of_event():
    return F.get_json_object("props", "$.k").cast("bigint")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uuid, tick (epoch seconds), edge_id."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("uuid"), F.unix_timestamp("ts").alias("tick"),
        _edge_of_event().alias("edge_id"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with a disordered arrival sequence."""
    disorder = (F.col("event_id") * 37) % 101
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("uuid"), F.unix_timestamp("ts").alias("tick"),
        _edge_of_event().alias("edge_id"),
        (F.shiftleft(disorder, 40) + F.col("event_id")).alias("seq"))


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edge_id, length. Large parts are left out, so that some edges are unknown."""
    return (table(spark, sf_dir, "part").where(F.col("p_size") <= 40)
            .select(F.col("p_partkey").alias("edge_id"), F.col("p_retailprice").alias("length")))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speeds with slow outliers: event_type, edge_id (the user), avg_speed."""
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("user_id").alias("edge_id"),
        (500 - F.col("value")).alias("avg_speed"))


def _placed(rows: DataFrame, key: str, per_tile: int, east: int, north: int) -> DataFrame:
    """node_id, x, y in UTM metres: tiles of 12 by 8 km, sixteen in a row, with so many keys each.

    The area grows with the table, so the density stays.
    """
    k = F.col(key)
    tile = F.floor(k / per_tile)
    return rows.select(
        k.alias("node_id"),
        (2817000 + 12000 * (tile % 16) + (k * east) % 12000).cast("double").alias("x"),
        (7206500 + 8000 * F.floor(tile / 16) + (k * north) % 8000).cast("double").alias("y"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, x, y in UTM metres."""
    return _placed(table(spark, sf_dir, "customer"), "c_custkey", 1500, 4973, 3571)


def board_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node_id, x, y of the boards."""
    return _placed(table(spark, sf_dir, "supplier"), "s_suppkey", 100, 7919, 6151)


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows of the boards."""
    return catalog.boards(with_latlon(board_points(spark, sf_dir)))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edge_id, from_node, to_node, length."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("edge_id"), F.col("o_custkey").alias("from_node"),
        (F.col("o_custkey") + 1).alias("to_node"), F.col("o_totalprice").alias("length"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip demand; count may be 0 and equal trips occur."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("name"),
        F.col("o_orderstatus").alias("origin"),
        F.col("o_orderpriority").alias("destination"),
        (F.col("o_custkey") % 100).cast("string").alias("link_origin"),
        (F.col("o_custkey") % 6).cast("int").alias("count"),
        (F.col("o_orderkey") % 3600).cast("int").alias("start"),
        F.lit("car").alias("mode"))


def trip_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """last_tick, last_link, duration, distance and the data set a trip belongs to."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("last_tick"),
        F.col("l_linenumber").cast("bigint").alias("last_link"),
        F.col("l_extendedprice").alias("duration"), F.col("l_quantity").alias("distance"),
        (F.col("l_returnflag") == "R").alias("has_event"))


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested histories, a user's points of a day each, with every reason to reject a point:
    error events have no number for a tick, every eleventh event has no edge, and every
    29th user no uuid."""
    tick = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(
        F.unix_timestamp("ts").cast("string"))
    edge = F.when(F.col("event_id") % 11 != 0, _edge_of_event().cast("double"))
    point = F.struct(F.col("ts").cast("string").alias("date"), edge.alias("nodeID"),
                     tick.alias("tick"))
    return (table(spark, sf_dir, "events")
            .groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_list(point).alias("points"))
            .select(F.when(F.col("user_id") % 29 != 0, F.col("user_id").cast("string")).alias("uuid"),
                    F.struct(F.col("points").alias("current_location")).alias("capabilities")))
