"""Physical plans: no Python, no cross joins, no hints, pruned scans, shared shuffles."""

import pytest

from roadpulse.operators import movement, replay
from roadpulse.plans import tables as T
from roadpulse.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {n for n in QUERIES if n.startswith("stream_")} | {"rejected_position_messages"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_joins_without_broadcast(spark, name):
    """With broadcasting off, as for large tables, every join is still an equi-join."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(QUERIES[name](session, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    # The top two levels of the nearest-node grid have at most 64 and 4096 cells.
    assert text.count("BroadcastExchange") <= (2 if name.startswith("nearest_node") else 0)


def test_scan_reads_only_what_is_used(spark):
    text = plan(movement.moves(T.positions(spark, SF_DIR)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>" in text
    text = plan(T.lengths(spark, SF_DIR))
    assert "LessThanOrEqual(p_size,40)" in text


def test_positions_are_shuffled_once(spark):
    text = final_plan(movement.moves(T.positions(spark, SF_DIR)))
    assert text.count("ReusedExchange") == 1
    arrivals, edges = T.arrivals(spark, SF_DIR), T.lengths(spark, SF_DIR)
    text = final_plan(replay.replay_speeds(arrivals, edges))
    assert "ReusedExchange" in text


def test_counts_meet_the_edges_not_the_moves(spark):
    """Training joins lengths to (edge, tick difference) counts."""
    counts = movement.speed_counts(T.positions(spark, SF_DIR), T.lengths(spark, SF_DIR))
    lines = plan(counts).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate(keys=[edge_id" in line for line in lines[join:])


def test_hot_edge_is_split_in_the_join(spark):
    """Without broadcasting, AQE divides the partition of an edge holding most moves."""
    from pyspark.sql import functions as F
    session = spark.newSession()
    for key, value in {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        session.conf.set(key, value)
    positions = session.range(60000, numPartitions=8).select(
        (F.col("id") % 500).cast("string").alias("uuid"), F.col("id").alias("tick"),
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 400).alias("edge_id"))
    edges = session.range(300).select(F.col("id").alias("edge_id"), F.lit(2.0).alias("length"))
    joined = movement.edge_speeds(positions, edges)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000 - 500


def test_hot_cell_is_split_in_the_join(spark):
    """AQE divides the points of one cell; the points themselves are shuffled once, by cell."""
    from pyspark.sql import functions as F
    from roadpulse.operators.spatial import within_radius
    session = spark.newSession()
    for key, value in {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        session.conf.set(key, value)
    points = session.range(60000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 > 0, -23.5).otherwise(-23.5 - F.col("id") % 400 / 20).alias("lat"),
        (-46.6 + F.col("id") % 7 / 1e6).alias("lon"))
    sites = session.range(5).select(F.col("id").alias("site"), F.lit(-23.5).alias("lat"),
                                    (F.lit(-46.6) + F.col("id") / 1000).alias("lon"))
    pairs = within_radius(points, sites)
    text = final_plan(pairs)
    assert "skew=true" in text and text.count("REPARTITION") == 0
    assert pairs.count() == 5 * points.where("lat = -23.5").count()
