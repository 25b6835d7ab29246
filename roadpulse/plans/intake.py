"""Named queries on what the sources hold: unusable lines and elements, and numbers observed on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import movement, sketches
from roadpulse.operators import trips as trip_ops
from roadpulse.operators.observed import TrainingMetrics
from roadpulse.plans import tables as T
from roadpulse.plans.jobs import train
from roadpulse.session import fresh_path, settle
from roadpulse.sinks import files as out
from roadpulse.sources import files as src


def _written(lines: DataFrame, name: str) -> str:
    path = fresh_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


def _texts(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories, and lines that break off, are no JSON, or hold a word for a number."""
    good = T.histories(spark, sf_dir).select(F.to_json(F.struct("uuid", "capabilities")).alias("value"))
    event, user = F.col("event_id"), F.col("user_id")
    broken = (F.when(event % 17 == 0, _texts('{"uuid":"', user, '","capabilities":'))
              .when(event % 17 == 1, _texts("lost ", event))
              .when(event % 17 == 2, _texts('{"uuid":"', user, '","capabilities":{"current_location":'
                                            '[{"date":"d","nodeID":"x', event, '","tick":"1"}]}}')))
    bad = T.table(spark, sf_dir, "events").select(broken.alias("value")).where("value IS NOT NULL")
    return good.unionByName(bad)


def _model_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model with its header, and rows with a word for a bound, a column too few, or no edge."""
    key, size = F.col("p_partkey"), F.col("p_size")
    line = (F.when(key % 7 == 0, _texts("x3.0,1.5,0.5,", key)).when(key % 7 == 1, _texts(size, ".5,1.5,0.5"))
            .when(key % 7 == 2, _texts(size, ".5,1.5,0.5,")).when(key % 7 == 3, _texts(",,,", key))
            .otherwise(_texts(size, ".5,1.5,0.5,", key)))
    rows = T.table(spark, sf_dir, "part").select(line.alias("value"))
    header = spark.range(1).select(F.lit("mad,upper_threshold,lower_threshold,edgeId").alias("value"))
    return header.unionByName(rows)


def _vehicle_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    line = (F.when(key % 13 == 0, _texts("a;b;c;d;many;600;car;u", key)).when(key % 13 == 1, _texts("a;b;c;d;1;600;car"))
            .when(key % 13 == 2, "a;b;c;d;1;600;car;").otherwise(_texts("a;b;c;d;1;600;car;u", key)))
    return T.table(spark, sf_dir, "orders").select(line.alias("value"))


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    line = F.when(key % 19 == 0, _texts("7;0;", key, ";car;c;late;40;10")).otherwise(
        _texts("7;0;", key, ";car;c;", F.col("l_linenumber"), ";40;10"))
    return T.table(spark, sf_dir, "lineitem").select(line.alias("value"))


def rejected_history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.scan_histories(spark, _written(_history_lines(spark, sf_dir), "histories")).rejects


def rejected_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.scan_model(spark, _written(_model_lines(spark, sf_dir), "model")).rejects


def source_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of four text sources, all lines but headers, the usable and the rejected ones."""
    counts = None
    for name, lines, scan in (("histories", _history_lines, src.scan_histories), ("model", _model_lines, src.scan_model),
                              ("trip log", _log_lines, src.scan_trip_log), ("vehicles", _vehicle_lines, src.scan_vehicles)):
        path = _written(lines(spark, sf_dir), "lines")
        found = scan(spark, path)
        kinds = (spark.read.text(path).where("value NOT LIKE 'mad,upper%'").select(F.lit("lines").alias("kind"))
                 .unionAll(found.rows.select(F.lit("usable"))).unionAll(found.rejects.select(F.lit("rejected"))))
        row = kinds.agg(F.lit(name).alias("source"), *(F.count_if(F.col("kind") == k).alias(k)
                                                       for k in ("lines", "usable", "rejected")))
        counts = row if counts is None else counts.unionAll(row)
    return counts


def _map_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, some unreadable, and some inside comments and CDATA sections, one of which holds the other's mark."""
    key = F.col("o_orderkey")

    def link(name: Column | str, length: Column | str) -> Column:
        return _texts('<link id="', name, '" from="', F.col("o_custkey"), '" to="1" length="', length, '" note="a > b">text</link>')

    good, lost = link(key, F.col("o_totalprice")), link(key, "0")
    text = (F.when(key % 11 == 0, link(_texts("x", key), "1")).when(key % 11 == 1, link(key, "long"))
            .when(key % 11 == 2, _texts(good, "<![CDATA[", lost, "]]>"))
            .when(key % 11 == 3, _texts("<!-- <![CDATA[", lost, "-->", good, "]]>"))
            .when(key % 11 == 4, _texts("<![CDATA[ <!--", lost, "]]>", good, "-->"))
            .when(key % 11 == 5, _texts("<![CDATA[", lost, "<!-- --> ", lost, "]]><!-- ]]> ", lost, " -->", good))
            .when(key % 11 == 6, _texts('<link id="', key, '" from=', F.col("o_custkey"), ' to="1"/>')).otherwise(good))
    return T.table(spark, sf_dir, "orders").select(text.alias("value"))


def rejected_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that cannot be read, or hold a word for a number."""
    return src.scan_links(spark, _written(_map_text(spark, sf_dir), "links")).rejects


def links_outside_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.scan_links(spark, _written(_map_text(spark, sf_dir), "links")).rows


def rejected_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a file whose start or count is no whole number."""
    key, path = F.col("o_orderkey"), fresh_path(spark, "trips")
    start = (F.when(key % 5 == 0, _texts(key % 3600, ".5")).when(key % 5 == 1, _texts(key % 3600, ".0"))
             .otherwise((key % 3600).cast("string")))
    count = F.when(key % 7 != 0, _texts(key % 6))
    out.write_trips_xml(T.table(spark, sf_dir, "orders").select(
        key.cast("string").alias("name"), start.alias("start"), count.alias("count")), path)
    return trip_ops.usable_trips(src.read_trips(spark, path))[1].select("name", "start", "count", "reason")


# --- numbers observed -------------------------------------------------------------

def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers observed while a model is trained from histories."""
    metrics = TrainingMetrics()
    points = movement.flatten_histories(T.histories(spark, sf_dir))
    points = settle(metrics.positions(movement.judged_positions(points)), "positions")
    good, _ = movement.clean_positions(points.drop("reason"))
    out.write_model(train(good, T.lengths(spark, sf_dir), metrics=metrics), fresh_path(spark, "model"))
    return spark.createDataFrame(list(metrics.get().items()), "metric string, number bigint")


# --- approximate bounds -------------------------------------------------------------

def sketched_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds from daily sketches of two loads: the rank errors of median and deviation against the bound."""
    positions, edges = T.positions(spark, sf_dir), T.lengths(spark, sf_dir)
    path = fresh_path(spark, "sketches")
    day = F.floor(F.col("tick") / sketches.DAY_TICKS)
    ends = positions.agg(F.min(day), F.max(day)).first()
    middle = (ends[0] + ends[1]) // 2
    early, late = positions.where(day <= middle), positions.where(day > middle)
    sketches.add_days(path, early, edges)
    sketches.add_days(path, late, edges, sketches.last_points(early))
    bounds = sketches.sketched_bounds(sketches.read_sketches(spark, path))
    errors = sketches.rank_errors(bounds, movement.edge_speeds(positions, edges))
    return errors.select("edge_id", "n", (F.col("median_error") <= sketches.rank_error()).alias("median_within"),
                         (F.col("mad_error") <= sketches.deviation_error()).alias("mad_within"))


QUERIES = {f.__name__: f for f in (
    rejected_history_lines, rejected_model_rows, source_line_counts, rejected_links, links_outside_sections,
    rejected_trips, training_metrics, sketched_bounds)}
