"""The jobs, as functions of tables and paths; `roadpulse.__main__` gives them commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.geo import with_latlon
from roadpulse.operators import catalog, compare, movement, trips
from roadpulse.operators.observed import TrainingMetrics
from roadpulse.operators.robust import bounds_from_counts
from roadpulse.session import settle
from roadpulse.sinks import files as out
from roadpulse.sources import files as src


def usable(scan: src.Scan, rejects: str | None, name: str) -> DataFrame:
    """The rows of a source, its rejects written next to `rejects` as lines of JSON; without a
    folder for them, the first one is an error."""
    if not rejects:
        return scan.strict
    scan.rejects.write.mode("overwrite").json(f"{rejects}-{name}")
    return scan.rows


def _trips(spark: SparkSession, path: str, rejects: str | None) -> DataFrame:
    """The trips of a file that have a start and a count."""
    found = usable(src.scan_trips(spark, path), rejects, "elements")
    good, bad = trips.usable_trips(found)
    if rejects:
        bad.write.mode("overwrite").json(rejects)
        return good
    no_number = F.raise_error(F.concat(F.lit("trip without start or count: "), F.to_json(F.struct(*(F.col(f"`{c}`") for c in found.columns)))))
    return found.where(F.when(trips.is_usable(), F.lit(True)).otherwise(no_number.cast("boolean")))


def train(positions: DataFrame, edges: DataFrame, single_precision: bool = False,
          metrics: TrainingMetrics | None = None) -> DataFrame:
    """Thresholds per edge from vehicle positions (uuid, tick, edge_id)."""
    counts = movement.speed_counts(positions, edges)
    if metrics:  # written at once: ordering the counts looks at them twice
        counts = settle(metrics.moves(counts), "speed-counts")
    return bounds_from_counts(counts, ["edge_id"], single_precision=single_precision)


def train_model(spark: SparkSession, histories: str, road_map: str, model: str,
                rejects: str | None = None, single_precision: bool = False,
                inspect: bool = False) -> dict[str, int]:
    """Histories (JSON lines) and the road map (XML) -> model (CSV); the numbers observed on the way.

    `inspect` prints those and the first rows of each step.
    """
    metrics = TrainingMetrics()
    read = usable(src.scan_histories(spark, histories), rejects, "lines")
    # Written once, observed on the way; the model and the rejects are made from that.
    points = settle(metrics.positions(movement.judged_positions(movement.flatten_histories(read))), "positions")
    good, bad = movement.clean_positions(points.drop("reason"))
    edges = settle(usable(src.scan_links(spark, road_map), rejects, "elements"), "links")
    if inspect:
        good.show()
        movement.edge_speeds(good, edges).show(truncate=False)
    out.write_model(train(good, edges, single_precision, metrics), model)
    if inspect:
        for name, number in metrics.get().items():
            print(f"{name}: {number}")
        src.read_model(spark, model).show()
    if rejects:
        bad.write.mode("overwrite").json(rejects)
    return metrics.get()


def split_trip_file(spark: SparkSession, path: str, begin: int, end: int, target: str,
                    rejects: str | None = None) -> None:
    out.write_trips_xml(trips.split_trips(_trips(spark, path, rejects), begin, end), target)


def expand_trip_file(spark: SparkSession, path: str, target: str, seed: str | None = None,
                     rejects: str | None = None) -> None:
    out.write_vehicles_csv(trips.expand_trips(_trips(spark, path, rejects), seed), target)


def register_cars(spark: SparkSession, vehicles: str, resources: str, capabilities: str,
                  rejects: str | None = None) -> None:
    """Add every vehicle of an expanded trip file that the catalog lacks."""
    register_capability(spark, capabilities, catalog.LOCATION)
    out.register(catalog.cars(usable(src.scan_vehicles(spark, vehicles), rejects, "lines")), resources)


def register_capability(spark: SparkSession, path: str, name: str) -> None:
    rows = [row for row in catalog.CAPABILITY_ROWS if row[0] == name]
    out.register(spark.createDataFrame(rows, catalog.CAPABILITIES), path, "name")


def publish_board(spark: SparkSession, node_id: str, x: float, y: float,
                  resources: str, capabilities: str) -> None:
    """Add the board at a node's UTM coordinates, unless the catalog has it."""
    register_capability(spark, capabilities, catalog.BOARD)
    site = spark.createDataFrame([(node_id, x, y)], "node_id string, x double, y double")
    out.register(catalog.boards(with_latlon(site)), resources)


def convert_nodes(spark: SparkSession, road_map: str, target: str, rejects: str | None = None) -> None:
    """Nodes of the road map with latitude and longitude."""
    out.write_nodes_xml(with_latlon(usable(src.scan_nodes(spark, road_map), rejects, "elements")), target)


def compare_trip_logs(spark: SparkSession, baseline: str, events: str, target: str,
                      rejects: str | None = None) -> None:
    """Every destination of two trip logs, side by side, as CSV in a folder."""
    logs = [usable(src.scan_trip_log(spark, path), rejects, name)
            for name, path in (("baseline", baseline), ("events", events))]
    out.write_comparison(compare.overlay(compare.compare(*logs)), target)
