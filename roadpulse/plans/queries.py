"""Named queries over the given tables, one per operator or job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import arrays, messages
from roadpulse.functions.geo import with_grid, with_latlon
from roadpulse.operators import catalog, compare, detect, lookup, movement, robust, signs, spatial
from roadpulse.operators import trips as trip_ops
from roadpulse.operators.replay import replay_speeds
from roadpulse.plans import handover, intake
from roadpulse.plans import tables as T
from roadpulse.plans.handover import position_stream, streaming_session
from roadpulse.plans.jobs import train
from roadpulse.session import fresh_path
from roadpulse.sinks import files as out
from roadpulse.sinks import streams as stream_out
from roadpulse.sources import files as src
from roadpulse.sources import streams as stream_src
from roadpulse.streaming import alerts
from roadpulse.streaming.bulk import start_bulk_speeds
from roadpulse.streaming.speeds import SPEEDS, speed_records, speed_stream

SPLIT_BEGIN, SPLIT_END = 600, 1200
EXPANSION_SEED = "seed"
LABELS = {1: 3, 2: 4}


def _rounded(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


BOUNDS = ("median", "mad", "upper_threshold", "lower_threshold")


def _rounded_bounds(df: DataFrame, mean_digits: int = 9, digits: int = 9) -> DataFrame:
    return _rounded(_rounded(df, *BOUNDS, digits=digits), "mean", digits=mean_digits)


# --- training ---------------------------------------------------------------

def train_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_bounds(train(T.positions(spark, sf_dir), T.lengths(spark, sf_dir)))


def pair_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movement.edge_speeds(T.positions(spark, sf_dir), T.lengths(spark, sf_dir))


def flatten_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = movement.flatten_histories(T.histories(spark, sf_dir))
    return movement.clean_positions(points)[0]


def rejected_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = movement.flatten_histories(T.histories(spark, sf_dir))
    return movement.clean_positions(points)[1].select("uuid", "edge_id", "reason")


def edge_speed_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    speeds = movement.edge_speeds(T.positions(spark, sf_dir), T.lengths(spark, sf_dir))
    return _rounded(robust.deviations(speeds, ["edge_id"], "kmh")
                    .select("uuid", "tick", "edge_id", "median", "deviation"),
                    "median", "deviation")


def mad_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = T.table(spark, sf_dir, "events").select("user_id", "value")
    return _rounded_bounds(robust.mad_bounds(events, ["user_id"], "value"))


def mad_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys, each with a large share of the rows."""
    lines = T.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus",
                                                      "l_extendedprice")
    return _rounded_bounds(robust.mad_bounds(lines, ["l_returnflag", "l_linestatus"],
                                             "l_extendedprice"), 4, 6)


# --- detection --------------------------------------------------------------

def _speed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.observed(spark, sf_dir).select(
        messages.speed_message(F.col("edge_id"), F.col("avg_speed")).alias("value"))


def _user_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust.mad_bounds(T.observed(spark, sf_dir), ["edge_id"], "avg_speed")


def detect_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    speeds = detect.parse_speeds(_speed_messages(spark, sf_dir))
    found = detect.anomalies(speeds, _user_model(spark, sf_dir))
    return _rounded(found.select(
        "edge_id", "avg_speed", messages.anomaly_message(F.col("edge_text")).alias("message")),
        "avg_speed")


def flag_speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = T.observed(spark, sf_dir)
    model = robust.mad_bounds(seen, ["event_type"], "avg_speed")
    return detect.flag(seen, model, "event_type").select("event_id", "event_type", "is_anomaly")


def flag_unusable_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model with a NaN and a NULL bound and without some keys."""
    seen = T.observed(spark, sf_dir)
    lower = (F.when(F.col("event_type") == "click", F.lit(float("nan")))
             .when(F.col("event_type") != "view", F.lit(490.0)))
    model = (seen.where("event_type <> 'error'").select("event_type").distinct()
             .withColumn("lower_threshold", lower))
    return detect.flag(seen, model, "event_type").select("event_id", "event_type", "is_anomaly")


def rejected_speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed messages without a whole edge id or without a speed."""
    edge = (F.when(F.col("event_id") % 3 == 0, F.concat(F.col("edge_id").cast("string"), F.lit(".0")))
            .when(F.col("event_id") % 3 == 1, F.concat(F.col("edge_id").cast("string"), F.lit(".7")))
            .otherwise(F.col("edge_id").cast("string")))
    speed = F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("string"))
    sent = T.observed(spark, sf_dir).select(
        F.to_json(F.struct(edge.alias("edge_id"), speed.alias("avg_speed"))).alias("value"))
    return detect.rejected_speeds(sent)


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = T.table(spark, sf_dir, "events")
    return (events.select("event_id", messages.json_fields(["k", "missing"], "props"))
            .withColumn("k_id", messages.to_id(F.col("k")))
            .withColumn("k_number", messages.to_number(F.col("k"))))


# --- position stream --------------------------------------------------------

def stateful_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_speeds(T.arrivals(spark, sf_dir), T.lengths(spark, sf_dir))


def speed_message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    speeds = replay_speeds(T.arrivals(spark, sf_dir), T.lengths(spark, sf_dir))
    return detect.parse_speeds(speed_records(speeds))


def _routing_key():
    return (F.when(F.col("event_type") == "view", "north.car.current_location.simulated")
            .when(F.col("event_type") == "error", "car.current_location.real")
            .when(F.col("event_type") == "click", "car_current_location.simulated")
            .otherwise(F.concat(F.col("event_type"), F.lit(".current_location.simulated"))))


def routing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = T.table(spark, sf_dir, "events").select("event_id", _routing_key().alias("routing_key"))
    return keyed.where(messages.routing_matches(F.col("routing_key"),
                                                stream_src.POSITION_PATTERN))


# --- geometry and signs -----------------------------------------------------

def reproject_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(with_latlon(T.nodes(spark, sf_dir)), "lat", "lon", digits=7)


def project_to_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    places = T.table(spark, sf_dir, "customer").select(
        "c_custkey", (-23.0 - (key % 997) / 1000).alias("lat"),
        (-46.0 - (key % 991) / 1000).alias("lon"))
    return _rounded(with_grid(places), "x", "y", digits=3)


def boards_in_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = with_latlon(T.nodes(spark, sf_dir)).select("node_id", "lat", "lon")
    sites = catalog.having(T.boards(spark, sf_dir), catalog.BOARD).select(
        F.col("description").alias("board"), "lat", "lon")
    return _rounded(spatial.within_radius(points, sites).select("node_id", "board", "distance"),
                    "distance", digits=3)


def nearest_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = T.board_points(spark, sf_dir).withColumnRenamed("node_id", "board")
    return _rounded(spatial.nearest_node(points, T.nodes(spark, sf_dir))
                    .select("board", "node_id", "distance"), "distance")


def nearest_node_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within a few centimetres, as in degrees: depth follows density, not extent."""
    def small(places: DataFrame) -> DataFrame:
        return places.withColumns({"x": F.col("x") / 1048576, "y": F.col("y") / 1048576})

    points = small(T.board_points(spark, sf_dir)).withColumnRenamed("node_id", "board")
    return _rounded(spatial.nearest_node(points, small(T.nodes(spark, sf_dir)))
                    .select("board", "node_id", "distance"), "distance", digits=12)


def rejected_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards without a description or a place."""
    key = F.col("description").cast("bigint")
    boards = T.boards(spark, sf_dir).withColumns({
        "description": F.when(key % 3 != 0, F.col("description")),
        "lat": F.when(key % 5 != 0, F.col("lat"))})
    return signs.rejected_boards(boards).select("uuid", "reason")


def sign_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect.anomalies(T.observed(spark, sf_dir), _user_model(spark, sf_dir))
    return signs.sign_messages(found.select("edge_id"), T.links(spark, sf_dir),
                               T.nodes(spark, sf_dir), T.boards(spark, sf_dir))


def _mixed_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly messages, some without an edge id, some no JSON."""
    good = messages.anomaly_message(F.col("user_id"))
    return T.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.col("props"))
        .when(F.col("event_type") == "signup", F.lit("no json")).otherwise(good).alias("value"))


def rejected_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = T.lengths(spark, sf_dir).select(
        "edge_id", (F.col("edge_id") * 20).alias("from_node"), F.col("edge_id").alias("to_node"))
    found = signs.parse_anomalies(_mixed_anomalies(spark, sf_dir))
    return (signs.rejected_anomalies(found, edges, T.nodes(spark, sf_dir))
            .select("value", "edge_id", "reason"))


# --- trips, catalog, comparison ---------------------------------------------

def split_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_ops.split_trips(T.trips(spark, sf_dir), SPLIT_BEGIN, SPLIT_END)


def expand_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_ops.expand_trips(T.trips(spark, sf_dir), EXPANSION_SEED)


def _registered_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cars(T.table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
                        .select(F.col("c_custkey").cast("string").alias("uuid")))


def _wanted_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cars(T.table(spark, sf_dir, "orders")
                        .select(F.col("o_custkey").cast("string").alias("uuid")))


def _flat_catalog(rows: DataFrame) -> DataFrame:
    return _rounded(rows.withColumn("capabilities", F.array_join("capabilities", ",")),
                    "lat", "lon", digits=7)


def register_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cars that a catalog lacks, of which only the partitions of the wanted cars are read."""
    path = fresh_path(spark, "catalog")
    registered, wanted = _registered_cars(spark, sf_dir), catalog.with_bucket(_wanted_cars(spark, sf_dir))
    out.register(registered, path)
    present = src.in_buckets(spark, path, registered.schema, wanted)
    return _flat_catalog(catalog.absent(wanted, present).drop(catalog.BUCKET))


def boards_by_capability(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = _registered_cars(spark, sf_dir).unionByName(T.boards(spark, sf_dir))
    return _flat_catalog(catalog.having(everything, catalog.BOARD))


def trip_first_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.with_first_tick(T.trip_log(spark, sf_dir))
                    .select("last_tick", "duration", "first_tick"), "first_tick", digits=6)


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = T.trip_log(spark, sf_dir)
    return compare.compare(log.where(~F.col("has_event")), log.where(F.col("has_event")), LABELS)


def compare_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_compared(spark, sf_dir), "distance", "duration", digits=6)


def overlay_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.overlay(_compared(spark, sf_dir)), "distance_baseline",
                    "distance_events", "duration_baseline", "duration_events", digits=6)


# --- arrays and key-value tables --------------------------------------------

def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("points"))


def short_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of arrays of no, one and two elements."""
    short = F.slice("points", F.lit(1), (F.col("vec_id") % 3).cast("int"))
    pairs = _vectors(spark, sf_dir).select(
        "vec_id", F.posexplode_outer(arrays.consecutive_pairs(short)))
    return _rounded(pairs.select("vec_id", "pos", "col.first", "col.second"), "first", "second")


def consecutive_pairs_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = arrays.consecutive_pairs(F.col("points"))
    return _rounded(_vectors(spark, sf_dir).select("vec_id", F.posexplode(pairs))
                    .select("vec_id", "pos", "col.first", "col.second"), "first", "second")


def array_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    centred = _vectors(spark, sf_dir).withColumn("median", arrays.array_median(F.col("points")))
    off = arrays.absolute_deviations(F.col("points"), F.col("median"))
    return _rounded(centred.select("vec_id", "median", F.posexplode(off).alias("pos", "deviation")),
                    "median", "deviation")


def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = T.table(spark, sf_dir, "lineitem")
    position = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return (lookup.last_write_wins(
        lines.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber",
                     "l_extendedprice"), ["l_partkey"], position)
        .select("l_partkey", "l_orderkey", "l_extendedprice"))


# --- through files ----------------------------------------------------------

def road_map_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with coordinates and links, written and read back, then joined."""
    nodes_at, links_at = fresh_path(spark, "nodes"), fresh_path(spark, "links")
    out.write_nodes_xml(with_latlon(T.nodes(spark, sf_dir)), nodes_at)
    out.write_links_xml(T.links(spark, sf_dir), links_at)
    nodes = src.read_nodes(spark, nodes_at)
    links = src.read_links(spark, links_at)
    return links.join(nodes, links.from_node == nodes.node_id).select(
        "edge_id", "from_node", "to_node", "length", "x", "y")


def repeated_ids_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A road map whose ids repeat in one file, and comments that hold elements: the last one counts."""
    path = fresh_path(spark, "links")
    # Many files, in order of their names.
    customers = T.table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    link = F.format_string('<link id="%s" from="%s" to="%s" length="%s.5"/>', F.col("c_custkey") % 97,
                           "c_custkey", F.col("c_custkey") + 1, "c_custkey")
    customers.select(F.when(F.col("c_custkey") % 2 == 0, F.concat(
        link, F.lit("<!-- "), F.replace(link, F.lit(".5"), F.lit(".9")), F.lit(" -->")))
        .otherwise(link)).write.text(path)
    return src.read_links(spark, path)


def nodes_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes written with latitude and longitude and read back."""
    path = fresh_path(spark, "nodes")
    out.write_nodes_xml(with_latlon(T.nodes(spark, sf_dir)), path)
    return _rounded(src.read_nodes(spark, path, latlon=True), "lat", "lon", digits=7)


def trips_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written, read back, cut and written again; extra attributes stay."""
    first, second = fresh_path(spark, "trips"), fresh_path(spark, "trips-splitted")
    out.write_trips_xml(T.trips(spark, sf_dir).withColumn("note", F.lit("kept")), first)
    out.write_trips_xml(trip_ops.split_trips(src.read_trips(spark, first),
                                             SPLIT_BEGIN, SPLIT_END), second)
    return src.read_trips(spark, second).select(
        "name", "origin", "destination", "link_origin", F.col("count").cast("int").alias("count"),
        F.col("start").cast("int").alias("start"), "mode", "note")


def vehicles_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "vehicles")
    out.write_vehicles_csv(trip_ops.expand_trips(T.trips(spark, sf_dir), EXPANSION_SEED), path)
    return src.read_vehicles(spark, path).select("uuid", "name", "start")


def model_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "model")
    out.write_model(train(T.positions(spark, sf_dir), T.lengths(spark, sf_dir)), path)
    return _rounded(src.read_model(spark, path), "mad", "upper_threshold", "lower_threshold")


def trip_log_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both logs written as text, read back and compared."""
    log = T.trip_log(spark, sf_dir).select(
        F.lit(7).alias("hour"), F.lit(0).alias("minute"), "last_tick", F.lit("car").alias("type"),
        F.lit("c").alias("car_id"), "last_link", "duration", "distance", "has_event")
    paths = {}
    for flag in (False, True):
        paths[flag] = fresh_path(spark, "trip-log")
        (log.where(F.col("has_event") == flag).drop("has_event")
         .write.option("sep", ";").csv(paths[flag]))
    compared = compare.compare(src.read_trip_log(spark, paths[False]),
                               src.read_trip_log(spark, paths[True]), LABELS)
    return _rounded(compared, "distance", "duration", digits=6)


def histories_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "histories")
    T.histories(spark, sf_dir).write.json(path)
    return movement.clean_positions(movement.flatten_histories(
        src.read_histories(spark, path)))[0]


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cars registered twice over; the second run adds nothing."""
    path = fresh_path(spark, "catalog")
    out.register(_registered_cars(spark, sf_dir), path)
    for _ in range(2):
        out.register(_wanted_cars(spark, sf_dir), path)
    return _flat_catalog(src.read_catalog(spark, path))


# --- through streaming queries ----------------------------------------------

def _landed(frame: DataFrame, name: str) -> str:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return path


def _drain(stream: DataFrame, name: str) -> str:
    """Run a stream over all that has arrived; the folder it wrote to."""
    spark = stream.sparkSession
    path = fresh_path(spark, name)
    stream_out.to_files(stream, path, fresh_path(spark, f"{name}-checkpoint")).awaitTermination()
    return path


def rejected_position_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a position stream leaves out: no vehicle, tick or edge, or no whole number for one."""
    tick = F.when(F.col("event_id") % 7 == 0, F.lit("12.7")).otherwise(
        F.unix_timestamp("ts").cast("string"))
    edge = F.when(F.col("event_id") % 11 != 0, F.lit("12.0"))
    uuid = F.when(F.col("event_id") % 13 != 0, F.col("user_id").cast("string"))
    body = F.to_json(F.struct(uuid.alias("uuid"), tick.alias("tick"), edge.alias("nodeID")))
    sent = T.table(spark, sf_dir, "events").select(
        F.lit("car.current_location.simulated").alias("key"), body.alias("value"),
        F.col("event_id").alias("seq"))
    stream = stream_src.rejected_positions(stream_src.file_messages(spark, _landed(sent, "positions")))
    return (spark.read.schema("value string, seq bigint, reason string")
            .parquet(_drain(stream, "rejects")).select("seq", "reason"))


def stream_stateful_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = streaming_session(spark)
    points = position_stream(session, sf_dir)
    speeds_at = _drain(speed_stream(points, T.lengths(session, sf_dir)), "speeds")
    return spark.read.schema(SPEEDS).parquet(speeds_at)


def stream_bulk_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    speeds_at, checkpoint = fresh_path(spark, "speeds"), fresh_path(spark, "speeds-checkpoint")
    query = start_bulk_speeds(
        position_stream(spark, sf_dir), T.lengths(spark, sf_dir), f"{checkpoint}/vehicles",
        lambda rows, i: rows.write.mode("overwrite").parquet(f"{speeds_at}/batch={i}"),
        f"{checkpoint}/query")
    query.awaitTermination()
    return spark.read.schema(SPEEDS).parquet(speeds_at).drop("batch")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream stopped after the first half of its files and started again on all of them."""
    sent = T.table(spark, sf_dir, "events").select(
        _routing_key().alias("key"), "event_type", F.col("event_id").alias("seq"))
    sent = sent.select("key", F.col("event_type").alias("value"), "seq")
    source, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))
    for half in (0, 1):
        sent.where(F.col("seq") % 2 == half).write.mode("append").parquet(source)
        stream = stream_src.file_messages(spark, source)
        stream_out.to_files(stream, target, checkpoint).awaitTermination()
    return spark.read.schema(stream_src.MESSAGE_FILE).parquet(target)


def stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detection with two sinks: the anomaly messages of the first."""
    session = streaming_session(spark)
    speeds_at = _landed(_speed_messages(session, sf_dir).select(
        F.lit(None).cast("string").alias("key"), "value", F.lit(0).cast("bigint").alias("seq")), "speeds")
    target, checkpoint = fresh_path(spark, "anomalies"), fresh_path(spark, "checkpoint")
    lower = F.lit(480.0).alias("lower_threshold")
    model = T.observed(session, sf_dir).select("edge_id").distinct().select("edge_id", lower)
    for query in alerts.start_alerts(stream_src.file_messages(session, speeds_at), model,
                                     lambda frame, at: stream_out.to_files(frame, target, at),
                                     checkpoint, show_every=None):
        query.awaitTermination()
    return spark.read.schema("value string").parquet(target)


def stream_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed messages -> anomalies -> sign messages, as two chained streams."""
    session = streaming_session(spark)
    record = [F.lit(None).cast("string").alias("key"), "value",
              F.lit(0).cast("bigint").alias("seq")]
    speeds_at = _landed(_speed_messages(session, sf_dir).select(*record), "speed-messages")
    found = alerts.detect(stream_src.file_messages(session, speeds_at),
                          _user_model(session, sf_dir))
    anomalies_at = _drain(detect.anomaly_messages(found).select(*record), "anomaly-messages")
    signs_at = _drain(alerts.signs(
        stream_src.file_messages(session, anomalies_at), T.links(session, sf_dir),
        T.nodes(session, sf_dir), T.boards(session, sf_dir)), "sign-messages")
    return spark.read.schema("key string, value string").parquet(signs_at)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        train_thresholds, pair_speed, flatten_histories, rejected_positions,
        edge_speed_deviations, mad_by_key, mad_by_flag,
        detect_anomalies, flag_speeds, flag_unusable_bounds, rejected_speeds, json_extract,
        stateful_speed, speed_message_round_trip, routing_filter,
        reproject_nodes, project_to_grid, boards_in_radius, nearest_node, nearest_node_dense,
        sign_messages, rejected_anomalies, rejected_boards, rejected_position_messages,
        split_trips, expand_trips, register_absent, boards_by_capability,
        trip_first_ticks, compare_destinations, overlay_destinations,
        consecutive_pairs_array, short_arrays, array_deviations, last_write_wins,
        road_map_xml, repeated_ids_xml, nodes_xml, trips_xml, vehicles_csv, model_csv, trip_log_csv, histories_json,
        catalog_table, stream_stateful_speed, stream_bulk_speed, stream_signs, stream_restart,
        stream_two_sinks,
    )
} | intake.QUERIES | handover.QUERIES
