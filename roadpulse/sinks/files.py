"""Files and tables the jobs write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.catalog import BUCKET, BUCKETS, absent, with_bucket
from roadpulse.session import settle
from roadpulse.sources.files import in_buckets

# Fixed value: root element of trip files.
TRIPS_ROOT = "scsimulator_matrix"


def write_model(bounds: DataFrame, path: str) -> None:
    (bounds.select("mad", "upper_threshold", "lower_threshold", F.col("edge_id").alias("edgeId"))
     .write.mode("overwrite").option("header", True).csv(path))


def _as_attributes(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: f"_{c}" for c in df.columns})


def write_trips_xml(trips: DataFrame, path: str) -> None:
    (_as_attributes(trips).write.mode("overwrite").format("xml")
     .option("rootTag", TRIPS_ROOT).option("rowTag", "trip").option("declaration", "").save(path))


def write_nodes_xml(nodes: DataFrame, path: str) -> None:
    """<node id x y lat lon/> elements."""
    (_as_attributes(nodes.withColumnRenamed("node_id", "id"))
     .write.mode("overwrite").format("xml")
     .option("rootTag", "nodes").option("rowTag", "node").option("declaration", "").save(path))


def write_links_xml(edges: DataFrame, path: str) -> None:
    links = edges.select(F.col("edge_id").alias("_id"), F.col("from_node").alias("_from"),
                         F.col("to_node").alias("_to"), F.col("length").alias("_length"))
    (links.write.mode("overwrite").format("xml")
     .option("rootTag", "links").option("rowTag", "link").option("declaration", "").save(path))


def write_vehicles_csv(vehicles: DataFrame, path: str) -> None:
    vehicles.write.mode("overwrite").option("sep", ";").csv(path)


def write_comparison(compared: DataFrame, path: str) -> None:
    compared.write.mode("overwrite").option("header", True).csv(path)


def register(wanted: DataFrame, path: str, key: str = "uuid", buckets: int = BUCKETS) -> None:
    """Add the rows whose key the table at `path` lacks.

    The table is partitioned by a hash of the key. Only partitions that the wanted keys fall into
    are read, and only those with something new are written, each anew with what it held. So a
    run that is repeated after a failure at any point writes the same partitions again, and
    no key comes in twice.
    """
    spark = wanted.sparkSession
    rows = settle(with_bucket(wanted, key, buckets).where(F.col(key).isNotNull()).dropDuplicates([key]), "wanted")
    present = in_buckets(spark, path, wanted.schema, rows)
    new = settle(absent(rows, present, key), "absent") if present is not None else rows
    kept = in_buckets(spark, path, wanted.schema, new)
    # What is overwritten depends on what was there: written elsewhere first.
    whole = new if kept is None else settle(new.unionByName(kept), "partitions")
    (whole.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))
