"""Named queries on streams that stop, fail, hand over their state or feed two sinks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.messages import speed_message
from roadpulse.operators import detect
from roadpulse.plans import tables as T
from roadpulse.session import fresh_path
from roadpulse.sinks import streams as stream_out
from roadpulse.sources import streams as stream_src
from roadpulse.streaming import alerts
from roadpulse.streaming.metrics import Totals
from roadpulse.streaming.speeds import SPEEDS, held_ticks, speed_stream


def streaming_session(spark: SparkSession) -> SparkSession:
    """Same application, own settings: the state store."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions",
                     spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return session


def spread(session: SparkSession) -> int:
    """Into how many files, or partitions of a stream's state, messages go: enough for all cores. A
    stream keeps its number for life, and a store each, so twice the cores are the most."""
    return min(int(session.conf.get("spark.sql.shuffle.partitions")),
               2 * session.sparkContext.defaultParallelism)


def ordered_messages(session: SparkSession, sf_dir: str, parts: int = 4) -> list[DataFrame]:
    """The arrivals as position messages in parts that follow each other."""
    body = F.to_json(F.struct("uuid", "tick", F.col("edge_id").cast("double").alias("nodeID")))
    sent = T.arrivals(session, sf_dir).select(
        F.lit("car.current_location.simulated").alias("key"), body.alias("value"), "seq")
    part = F.least(F.floor(F.col("seq") / F.lit((101 << 40) // parts)), F.lit(parts - 1))
    return [sent.where(part == k).repartition(spread(session), "seq") for k in range(parts)]


def position_stream(session: SparkSession, sf_dir: str, parts: int = 4) -> DataFrame:
    """The arrivals as a stream, a micro-batch per part: a stream takes the oldest files first."""
    path, files = fresh_path(session, "positions"), spread(session)
    for k, part in enumerate(ordered_messages(session, sf_dir, parts), 1):
        part.write.mode("append").parquet(path)
        # A file for every partition, also one without rows, so that no micro-batch holds half a part.
        for _ in range(k * files - len(session.read.schema(stream_src.MESSAGE_FILE).parquet(path).inputFiles())):
            session.createDataFrame([], stream_src.MESSAGE_FILE).write.mode("append").parquet(path)
    return stream_src.positions(stream_src.file_messages(session, path, per_trigger=files))


def stream_state_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A speed stream over the first arrivals; its state, read from its checkpoint, starts a second
    one with other partitions on the later arrivals."""
    first, second = streaming_session(spark), streaming_session(spark)
    early, late = ordered_messages(first, sf_dir, 2)
    targets, held, partitions = [], None, spread(first)
    for session, part, stores in ((first, early, partitions), (second, late, 2 * partitions)):
        path, target, checkpoint = (fresh_path(spark, n) for n in ("positions", "speeds", "checkpoint"))
        part.write.parquet(path)
        session.conf.set("spark.sql.shuffle.partitions", stores)
        points = stream_src.positions(stream_src.file_messages(session, path))
        speeds = speed_stream(points, T.lengths(session, sf_dir), held)
        stream_out.to_files(speeds, target, checkpoint).awaitTermination()
        held = held_ticks(second, checkpoint)
        targets.append(target)
    return spark.read.schema(SPEEDS).parquet(*targets)


def _speed_files(session: SparkSession, sf_dir: str, name: str = "speed-messages") -> str:
    path = fresh_path(session, name)
    (T.observed(session, sf_dir).select(
        F.lit(None).cast("string").alias("key"),
        F.when(F.col("event_id") % 9 == 0, "no json").when(F.col("event_id") % 9 == 1, F.to_json(F.struct("edge_id")))
        .otherwise(speed_message(F.col("edge_id"), F.col("avg_speed"))).alias("value"),
        F.col("event_id").alias("seq")).repartition(3).write.parquet(path))
    return path


def _low_model(session: SparkSession, sf_dir: str) -> DataFrame:
    return T.observed(session, sf_dir).select("edge_id").distinct().select(
        "edge_id", F.lit(480.0).alias("lower_threshold"))


def stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detection that fails in its second micro-batch, after the write and before the commit, and
    is started again: every anomaly is there once."""
    session = streaming_session(spark)
    source = _speed_files(session, sf_dir)
    target, checkpoint, failed = fresh_path(spark, "anomalies"), fresh_path(spark, "checkpoint"), []

    def fail_once(batch_id: int) -> None:
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    for _ in range(2):
        found = alerts.detect(stream_src.file_messages(session, source, per_trigger=1), _low_model(session, sf_dir))
        query = stream_out.to_batches(found.select("edge_id", "avg_speed"), target, checkpoint, written=fail_once)
        try:
            query.awaitTermination()
        except Exception:
            if "lost after the write" not in str(query.exception()):
                raise
    if failed != [1]:
        raise RuntimeError("the stream did not fail where it should")
    return spark.read.schema("edge_id bigint, avg_speed double").parquet(target).select(
        "edge_id", F.round("avg_speed", 9).alias("avg_speed"))


def _fan_out(spark: SparkSession, sf_dir: str) -> tuple[str, str, Totals]:
    """The folders of both sinks and the numbers observed."""
    session = streaming_session(spark)
    messages = stream_src.file_messages(session, _speed_files(session, sf_dir), per_trigger=1)
    sent, shown, totals = fresh_path(spark, "messages"), fresh_path(spark, "rows"), Totals("speeds")
    session.streams.addListener(totals)
    try:
        query = alerts.start_fan_out(messages, _low_model(session, sf_dir), [
            lambda found, i: stream_out.batch_to(detect.anomaly_messages(found), None, "", sent, i),
            lambda found, i: stream_out.batch_to(found.select("edge_id", "avg_speed"), None, "", shown, i),
        ], fresh_path(spark, "checkpoint"))
        query.awaitTermination()
        totals.get()
    finally:
        session.streams.removeListener(totals)
    return sent, shown, totals


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sinks of one detection, fed from one read of each micro-batch."""
    sent, shown, _ = _fan_out(spark, sf_dir)
    rows = spark.read.schema("edge_id bigint, avg_speed double").parquet(shown)
    return (spark.read.schema("value string").parquet(sent).select(F.lit("messages").alias("sink"), "value")
            .unionAll(rows.select(F.lit("rows"), speed_message(F.col("edge_id"), F.round("avg_speed", 6)))))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers a detection reports with its progress, added up over its micro-batches."""
    _, _, totals = _fan_out(spark, sf_dir)
    rows = [*totals.get().items(), ("input rows", totals.rows)]
    return spark.createDataFrame(rows, "metric string, number bigint")


QUERIES = {f.__name__: f for f in (stream_state_handover, stream_recovery, stream_fan_out, stream_metrics)}
