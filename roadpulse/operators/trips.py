"""Trip demand: cut to a time span, expand to one row per vehicle."""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.messages import to_id
from roadpulse.operators.lookup import split_rejects

TRIP_ATTRIBUTES = ["name", "origin", "destination", "link_origin", "count", "start", "mode"]
JITTER_TICKS = 25
# Vehicles one row generates at a time; larger trips are spread over tasks.
CHUNK = 1 << 18


def _whole(name: str) -> Column:
    """A number from an attribute, as text or not; NULL if it is no whole number of 32 bits."""
    return to_id(F.col(name).cast("string")).try_cast("int")


def is_usable() -> Column:
    return _whole("start").isNotNull() & _whole("count").isNotNull()


def usable_trips(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trips with a start and a count, the others with a reason)."""
    reason = F.when(_whole("start").isNull(), "no start").when(_whole("count").isNull(), "no count")
    return split_rejects(trips, reason)


def split_trips(trips: DataFrame, begin: int, end: int) -> DataFrame:
    """Trips with begin <= start <= end, rebased to begin, their count halved upwards."""
    start, count = _whole("start"), _whole("count")
    return trips.where(start.between(begin, end)).withColumns({
        "start": start - begin, "count": F.ceil(count / 2).cast("int")})


def _digest(seed: str, parts: list[Column]) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit(""))
                                                 for p in parts]))


def _as_uuid(digest: Column) -> Column:
    """32 hex digits in the layout of a random (version 4) UUID."""
    return F.concat(F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-4"),
                    F.substring(digest, 14, 3), F.lit("-a"), F.substring(digest, 18, 3),
                    F.lit("-"), F.substring(digest, 21, 12))


def expand_trips(trips: DataFrame, seed: str | None = None, tasks: int | None = None,
                 chunk: int = CHUNK) -> DataFrame:
    """One row per vehicle: the trip's attributes, count 1, a start delayed by 0 to 25
    ticks and an own uuid.

    Delay and uuid are drawn by hashing the trip, the vehicle's number and a
    seed (random per run if none is given), so that a repeated task gives the
    same rows. Equal trips are merged first; a large trip is generated in
    chunks on several tasks.
    """
    spark = trips.sparkSession
    seed = secrets.token_hex(8) if seed is None else seed
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    attributes = [a for a in TRIP_ATTRIBUTES if a != "count"]
    count = F.greatest(_whole("count").cast("bigint"), F.lit(0))
    merged = trips.groupBy(*attributes).agg(F.sum(count).alias("vehicles"))
    # A fixed number of partitions: the rows grow manyfold after this exchange.
    chunks = (merged.where(F.col("vehicles") > 0)
              .withColumn("chunk", F.explode(F.sequence(
                  F.lit(0).cast("bigint"), F.floor((F.col("vehicles") - 1) / chunk))))
              .repartition(tasks, *attributes, "chunk"))
    first = F.col("chunk") * chunk
    last = F.least(first + chunk, F.col("vehicles")) - 1
    digest = F.col("_digest")
    return (chunks
            .withColumn("vehicle", F.explode(F.sequence(first, last)))
            .withColumn("_digest", _digest(seed, [F.col(c) for c in (*attributes, "vehicle")]))
            .withColumn("delay", F.conv(F.substring(digest, 1, 6), 16, 10).cast("int")
                        % (JITTER_TICKS + 1))
            .select("name", "origin", "destination", "link_origin", F.lit(1).alias("count"),
                    (_whole("start") + F.col("delay")).alias("start"), "mode",
                    _as_uuid(digest).alias("uuid")))
