"""Message streams: a Kafka topic, or files holding the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.messages import json_fields, once, routing_matches, to_id

MESSAGE_FILE = "key string, value string, seq bigint"
# Topics, and the pattern position messages are routed under.
SPEED_TOPIC = "data_stream"
ANOMALY_TOPIC = "anomalies"
SIGN_TOPIC = "traffic_sign"
POSITION_PATTERN = "*.current_location.simulated"


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   starting: str | None = None, per_trigger: int | None = None,
                   options: dict[str, str] | None = None) -> DataFrame:
    """key, value, seq of a topic; seq follows the order inside each partition.

    `starting` is where the first run of a query begins: 'earliest', 'latest' or
    offsets as JSON; by default the earliest, so that a first run that drains a
    topic handles what it holds. `per_trigger` bounds the messages of a micro-batch.
    """
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic,
                "failOnDataLoss": "false", "startingOffsets": starting or "earliest",
                **({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {}),
                **(options or {})}
    return (spark.readStream.format("kafka").options(**settings).load()
            .select(F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value"),
                    (F.shiftleft(F.col("partition").cast("bigint"), 48)
                     + F.col("offset")).alias("seq")))


def file_messages(spark: SparkSession, path: str, file_format: str = "parquet",
                  per_trigger: int | None = None) -> DataFrame:
    """key, value, seq of message files, as they arrive in a folder.

    `per_trigger` bounds the files of a micro-batch.
    """
    reader = spark.readStream.format(file_format).schema(MESSAGE_FILE)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)


def _parsed_positions(messages: DataFrame, pattern: str) -> DataFrame:
    """value, uuid, seq, tick, edge_id of the messages routed under the pattern."""
    seq = F.coalesce("seq", F.raise_error(F.lit("position message without seq")).cast("bigint"))
    return (messages.where(routing_matches(F.col("key"), pattern))
            .select("value", seq.alias("seq"), json_fields(["uuid", "tick", "nodeID"]))
            .select(once("value", "uuid", "seq", to_id(F.col("tick")).alias("tick"),
                         to_id(F.col("nodeID")).alias("edge_id"))))


def rejected_positions(messages: DataFrame, pattern: str = POSITION_PATTERN) -> DataFrame:
    """value, seq, reason: routed messages that `positions` leaves out."""
    reason = (F.when(F.col("uuid").isNull(), "no uuid").when(F.col("tick").isNull(), "no tick")
              .when(F.col("edge_id").isNull(), "no edge"))
    return (_parsed_positions(messages, pattern).select("value", "seq", reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def positions(messages: DataFrame, pattern: str = POSITION_PATTERN) -> DataFrame:
    """uuid, seq, tick, edge_id of the messages whose key matches the routing pattern.

    Messages without a vehicle, tick or edge cannot move a vehicle's state and
    are left out here; `rejected_positions` lists them. A message without its
    place in the order is an error.
    """
    return (_parsed_positions(messages, pattern).drop("value")
            .where(F.col("uuid").isNotNull() & F.col("tick").isNotNull()
                   & F.col("edge_id").isNotNull()))
