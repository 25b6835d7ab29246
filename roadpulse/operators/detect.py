"""Speeds against thresholds; the same functions serve tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.messages import anomaly_message, json_fields, to_id, to_number


def parse_speeds(messages: DataFrame, value: str = "value") -> DataFrame:
    """Speed messages -> edge_text (as sent), edge_id, avg_speed; NULLs where malformed."""
    return (messages.select(json_fields(["edge_id", "avg_speed"], value))
            .select(F.col("edge_id").alias("edge_text"), to_id(F.col("edge_id")).alias("edge_id"),
                    to_number(F.col("avg_speed")).alias("avg_speed")))


def flag(speeds: DataFrame, model: DataFrame, key: str = "edge_id") -> DataFrame:
    """Add is_anomaly: slower than the lower bound of a known key.

    Spark orders NaN above every number, so an undefined bound is excluded by
    name. The upper bound takes no part.
    """
    lower = F.col("lower_threshold")
    slow = (F.col("avg_speed") < lower) & ~F.isnan(lower)
    return (speeds.join(model.select(key, "lower_threshold"), key, "left")
            .withColumn("is_anomaly", F.coalesce(slow, F.lit(False)))
            .drop("lower_threshold"))


def anomalies(speeds: DataFrame, model: DataFrame, key: str = "edge_id") -> DataFrame:
    """Only the anomalous rows; a key without a usable bound can give none."""
    lower = F.col("lower_threshold")
    usable = model.select(key, "lower_threshold").where(lower.isNotNull() & ~F.isnan(lower))
    return (speeds.join(usable, key).where(F.col("avg_speed") < lower).drop("lower_threshold"))


def rejected_speeds(messages: DataFrame, value: str = "value") -> DataFrame:
    """value, reason: speed messages that `anomalies` cannot judge, by their form."""
    parsed = messages.select(F.col(value).alias("value"), json_fields(["edge_id", "avg_speed"], value))
    reason = (F.when(to_id(F.col("edge_id")).isNull(), "no edge id")
              .when(to_number(F.col("avg_speed")).isNull(), "no speed"))
    return parsed.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


def anomaly_messages(found: DataFrame, edge: str = "edge_text") -> DataFrame:
    return found.select(anomaly_message(F.col(edge)).alias("value"))
