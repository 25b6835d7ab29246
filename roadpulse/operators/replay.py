"""Batch replay of the keyed speed rule of `roadpulse.streaming.speeds`.

The rule keeps one tick per vehicle. A point on a known edge always sets it; a
point on an unknown edge sets it only when it does not advance (or comes
first), i.e. leaves min(state, tick). Hence the state before a point is the
minimum tick since the last known-edge point, that one included, which windows
express without walking through a vehicle's history row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Arrivals are cut into slices of 2^20 sequence numbers. These are unique per
# vehicle, so no task ever orders more than that many points of one vehicle.
SLICE_BITS = 20


def _with_state(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add `state`, the tick in force before each row, and `state_after`.

    `start` is the tick in force before the first row of the keys, or NULL.
    """
    to_here = (Window.unboundedPreceding, Window.currentRow)
    in_order = Window.partitionBy(*keys).orderBy(order).rowsBetween(*to_here)
    in_run = Window.partitionBy(*keys, "_run").orderBy(order).rowsBetween(*to_here)
    in_runs = Window.partitionBy(*keys).orderBy("_run", order)
    lowest = F.min("tick").over(in_run)
    return (df
            .withColumn("_run", F.sum(F.col("known").cast("int")).over(in_order))
            .withColumn("state_after", F.when(F.col("_run") == 0, F.least("start", lowest))
                        .otherwise(lowest))
            .withColumn("state", F.coalesce(F.lag("state_after").over(in_runs), "start"))
            .drop("_run"))


def _slices(arrivals: DataFrame, edges: DataFrame, slice_bits: int,
            held: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(arrivals by vehicle and slice; per slice its `state`, the tick it starts
    with, and `state_after`)."""
    unset = F.lit(None).cast("bigint")
    keys = ["uuid", "slice"]
    rows = (arrivals.select("uuid", "seq", "tick", "edge_id")
            .join(edges.select("edge_id", "length"), "edge_id", "left")
            .withColumn("slice", F.shiftright("seq", slice_bits))
            .where(F.col("uuid").isNotNull() & F.col("slice").isNotNull())
            .repartition(*keys)
            .withColumn("known", F.col("length").isNotNull()))
    # The null checks above (which a join on the keys would add on its side only)
    # and naming all columns here make the shuffle of both passes the same.
    last = F.max_by(F.struct("state_after", "edge_id", "length"), "seq")
    summaries = (_with_state(rows.withColumn("start", unset), keys, "seq")
                 .groupBy(*keys).agg(F.max("known").alias("known"), last.alias("last"))
                 .select(*keys, "known", F.col("last.state_after").alias("tick")))
    if held is None:
        summaries = summaries.withColumn("start", unset)
    else:
        summaries = summaries.join(held.select("uuid", F.col("tick").alias("start")),
                                   "uuid", "left")
    return rows, _with_state(summaries, ["uuid"], "slice")


def replay_speeds(arrivals: DataFrame, edges: DataFrame, slice_bits: int = SLICE_BITS,
                  held: DataFrame | None = None) -> DataFrame:
    """uuid, seq, tick, edge_id, avg_speed of every accepted point.

    `arrivals` holds uuid, seq (arrival order, unique per vehicle), tick and
    edge_id; `held` (uuid, tick) is the state before them, if any. Each slice of arrivals is first summarised alone; the summaries,
    which obey the same rule, give the state each slice starts with. Both
    passes share one shuffle of the arrivals by vehicle and slice.
    """
    rows, slices = _slices(arrivals, edges, slice_bits, held)
    keys = ["uuid", "slice"]
    starts = slices.select(*keys, F.col("state").alias("start"))
    return (_with_state(rows.join(starts, keys), keys, "seq")
            .where(F.col("length").isNotNull() & (F.col("tick") > F.col("state")))
            .select("uuid", "seq", "tick", "edge_id",
                    (F.col("length") / (F.col("tick") - F.col("state"))).alias("avg_speed")))


def last_ticks(arrivals: DataFrame, edges: DataFrame, slice_bits: int = SLICE_BITS,
               held: DataFrame | None = None) -> DataFrame:
    """uuid, tick: the state the arrivals leave each vehicle in."""
    _, slices = _slices(arrivals, edges, slice_bits, held)
    after = slices.groupBy("uuid").agg(F.max_by("state_after", "slice").alias("tick"))
    if held is None:
        return after
    before = held.select("uuid", F.col("tick").alias("held"))
    return (after.join(before, "uuid", "full")
            .select("uuid", F.coalesce("tick", "held").alias("tick")))
