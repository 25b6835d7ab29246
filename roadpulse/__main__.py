"""Commands: python -m roadpulse <command>, or spark-submit of this file."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators import catalog, detect, signs
from roadpulse.plans import jobs
from roadpulse.session import build_session, scratch
from roadpulse.sinks import streams as stream_out
from roadpulse.sources import files as src
from roadpulse.sources import streams as stream_src
from roadpulse.streaming import alerts, bulk, health, speeds


def _messages(spark: SparkSession, args, topic: str) -> DataFrame:
    if args.servers:
        return stream_src.kafka_messages(spark, args.servers, topic, args.starting, args.per_trigger)
    return stream_src.file_messages(spark, args.input, per_trigger=args.per_trigger)


def _send(args, topic: str):
    """A function that starts a sink for a frame of messages, given its checkpoint."""
    if args.servers:
        return lambda frame, checkpoint: stream_out.to_kafka(
            frame, args.servers, topic, checkpoint, args.every)
    return lambda frame, checkpoint: stream_out.to_files(
        frame, args.output, checkpoint, every=args.every)


def _rejects(args, frame: DataFrame) -> list:
    """The query that writes rejected rows, if a folder for them is given."""
    if not args.rejects:
        return []
    return [stream_out.to_files(frame, args.rejects, f"{args.checkpoint}-rejects", "json", args.every)]


def _await(queries: list) -> None:
    for query in queries:
        query.awaitTermination()


def train_model(spark, args):
    with scratch(spark):
        numbers = jobs.train_model(spark, args.histories, args.map, args.model, args.rejects, args.float32,
                                   args.inspect)
    if args.metrics:
        rows = spark.createDataFrame(list(numbers.items()), "metric string, number bigint")
        rows.write.mode("overwrite").json(args.metrics)


def derive_speeds(spark, args):
    messages = _messages(spark, args, args.position_topic)
    points = stream_src.positions(messages)
    edges = jobs.usable(src.scan_links(spark, args.map), args.rejects, "elements")
    start = spark.read.schema(bulk.STATE).parquet(args.start) if args.start else None
    if args.take_over:
        start = speeds.held_ticks(spark, args.take_over)
    queries = _rejects(args, stream_src.rejected_positions(messages))
    if not args.replay:
        rows = speeds.speed_stream(points, edges, start)
        queries.append(_send(args, stream_src.SPEED_TOPIC)(speeds.speed_records(rows), args.checkpoint))
    else:
        def write(rows: DataFrame, batch_id: int) -> None:
            stream_out.batch_to(speeds.speed_records(rows), args.servers, stream_src.SPEED_TOPIC,
                                args.output, batch_id)

        queries.append(bulk.start_bulk_speeds(
            points, edges, f"{args.checkpoint}/vehicles", write, f"{args.checkpoint}/query",
            args.every, start))
    _await(queries)


def detect_anomalies(spark, args):
    messages = _messages(spark, args, stream_src.SPEED_TOPIC)
    model = jobs.usable(src.scan_model(spark, args.model), args.rejects, "model")
    if args.fan_out:
        started = [alerts.start_fan_out(messages, model, [
            lambda found, i: stream_out.batch_to(detect.anomaly_messages(found), args.servers,
                                                 stream_src.ANOMALY_TOPIC, args.output, i),
            lambda found, i: found.show(truncate=False)], args.checkpoint, args.every)]
    else:
        started = alerts.start_alerts(messages, model, _send(args, stream_src.ANOMALY_TOPIC),
                                      args.checkpoint, "1 seconds" if args.every else None)
    _await([*started, *_rejects(args, detect.rejected_speeds(messages))])


def publish_signs(spark, args):
    boards = catalog.having(src.read_catalog(spark, args.resources), catalog.BOARD)
    messages = _messages(spark, args, stream_src.ANOMALY_TOPIC)
    edges = jobs.usable(src.scan_links(spark, args.map), args.rejects, "links")
    nodes = jobs.usable(src.scan_nodes(spark, args.map), args.rejects, "nodes")
    sent = alerts.signs(messages, edges, nodes, boards, args.radius, not args.lenient)
    queries = [_send(args, stream_src.SIGN_TOPIC)(sent, args.checkpoint)]
    if args.lenient and args.rejects:
        queries += _rejects(args, alerts.rejected_signs(messages, edges, nodes))
        signs.rejected_boards(boards).write.mode("overwrite").json(f"{args.rejects}-boards")
    _await(queries)


def health_check(spark, args):
    health.start_health_check(_messages(spark, args, stream_src.SPEED_TOPIC),
                              args.every).awaitTermination()


def split_trips(spark, args):
    with scratch(spark):
        jobs.split_trip_file(spark, args.trips, args.begin, args.end, args.target, args.rejects)


def expand_trips(spark, args):
    with scratch(spark):
        jobs.expand_trip_file(spark, args.trips, args.target, args.seed, args.rejects)


def register_cars(spark, args):
    with scratch(spark):
        jobs.register_cars(spark, args.vehicles, args.resources, args.capabilities, args.rejects)


def publish_board(spark, args):
    with scratch(spark):
        jobs.publish_board(spark, args.node_id, args.x, args.y, args.resources, args.capabilities)


def convert_nodes(spark, args):
    with scratch(spark):
        jobs.convert_nodes(spark, args.map, args.target, args.rejects)


def compare_trips(spark, args):
    with scratch(spark):
        jobs.compare_trip_logs(spark, args.baseline, args.events, args.target, args.rejects)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roadpulse")
    commands = top.add_subparsers(dest="command", required=True)

    def command(function, *positional):
        sub = commands.add_parser(function.__name__.replace("_", "-"))
        sub.set_defaults(run=function)
        for name in positional:
            sub.add_argument(name)
        return sub

    def streaming(sub, sink: bool = True):
        sub.add_argument("--servers", help="Kafka servers; without them, folders are used")
        sub.add_argument("--input", help="folder of message files")
        sub.add_argument("--every", default=None,
                         help="trigger interval; without it, drain what is there and stop")
        sub.add_argument("--starting", help="where a first run begins in a topic: earliest "
                         "(the default), latest, or offsets as JSON")
        sub.add_argument("--per-trigger", type=int,
                         help="most messages of a topic, or files, in a micro-batch")
        if sink:
            sub.add_argument("--output", help="folder for messages")
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--rejects", help="folder for unusable messages, with reasons")

    def rejecting(sub):
        sub.add_argument("--rejects", help="folder for unusable rows, with reasons; those of the files "
                         "read go next to it. Without it, an unusable line of a file is an error")
        return sub

    sub = rejecting(command(train_model, "histories", "map", "model"))
    sub.add_argument("--metrics", help="folder for the numbers of points, rejects and moves")
    sub.add_argument("--float32", action="store_true", help="round medians to 32-bit floats")
    sub.add_argument("--inspect", action="store_true", help="print the first rows of each step")
    sub = command(derive_speeds, "map")
    sub.add_argument("--position-topic", default="positions")
    sub.add_argument("--start", help="folder of last ticks (uuid, tick) to start from")
    sub.add_argument("--take-over", help="checkpoint of a speed stream whose state to start from")
    sub.add_argument("--replay", action="store_true",
                     help="replay each micro-batch as a batch, for backfills")
    streaming(sub)
    sub = command(detect_anomalies, "model")
    sub.add_argument("--fan-out", action="store_true", help="one query, which reads each message once, for both sinks")
    streaming(sub)
    sub = command(publish_signs, "map", "resources")
    sub.add_argument("--radius", type=float, default=1000.0)
    sub.add_argument("--lenient", action="store_true", help="skip unusable anomalies")
    streaming(sub)
    streaming(command(health_check), sink=False)
    sub = rejecting(command(split_trips, "trips"))
    sub.add_argument("begin", type=int)
    sub.add_argument("end", type=int)
    sub.add_argument("target")
    sub = rejecting(command(expand_trips, "trips", "target"))
    sub.add_argument("--seed")
    rejecting(command(register_cars, "vehicles", "resources", "capabilities"))
    sub = command(publish_board, "node_id")
    sub.add_argument("x", type=float)
    sub.add_argument("y", type=float)
    sub.add_argument("resources")
    sub.add_argument("capabilities")
    rejecting(command(convert_nodes, "map", "target"))
    rejecting(command(compare_trips, "baseline", "events", "target"))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
