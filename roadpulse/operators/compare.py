"""Comparison of trips with and without road events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Destination links and the labels they are reported under.
DESTINATION_LABELS = {16: 3, 53: 19, 56: 20}


def with_first_tick(trips: DataFrame) -> DataFrame:
    return trips.withColumn("first_tick", F.col("last_tick") - F.col("duration"))


def destination_means(trips: DataFrame, has_event: bool) -> DataFrame:
    """last_link, distance, duration (means), has_event."""
    return (trips.where(F.col("last_link").isNotNull()).groupBy("last_link")
            .agg(F.avg("distance").alias("distance"), F.avg("duration").alias("duration"))
            .withColumn("has_event", F.lit(has_event)))


def relabel(link: Column, labels: dict[int, int]) -> Column:
    result = link
    for old, new in labels.items():
        result = F.when(link == old, F.lit(new)).otherwise(result)
    return result


def compare(baseline: DataFrame, events: DataFrame,
            labels: dict[int, int] = DESTINATION_LABELS) -> DataFrame:
    """last_link, has_event, distance, duration of both data sets.

    Labels apply after the first mean, so destinations that share one label are
    averaged with equal weight.
    """
    both = destination_means(baseline, False).unionByName(destination_means(events, True))
    return (both.withColumn("last_link", relabel(F.col("last_link"), labels))
            .groupBy("last_link", "has_event")
            .agg(F.avg("distance").alias("distance"), F.avg("duration").alias("duration")))


def overlay(compared: DataFrame) -> DataFrame:
    """One row per destination with both data sets side by side, NULL where one lacks it."""
    side = lambda name, flag: F.max(F.when(F.col("has_event") == flag, F.col(name)))
    return compared.groupBy("last_link").agg(
        side("distance", False).alias("distance_baseline"),
        side("distance", True).alias("distance_events"),
        side("duration", False).alias("duration_baseline"),
        side("duration", True).alias("duration_events"))
