"""Approximate medians and deviations from mergeable quantile sketches.

One sketch per edge and day is kept; training merges them, so a new day costs that day's
points, not the whole history. A sketch takes about 3 kB at most, whatever number of speeds
it stands for, and is made map-side before the shuffle.

The rank of a quantile is off by less than `rank_error(k)` with 99 % confidence, and not
at all while an edge has fewer speeds than the sketch holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.movement import edge_speeds
from roadpulse.operators.robust import MAD_SCALE

K = 800
DAY_TICKS = 86400
SKETCHES = "edge_id bigint, sketch binary, n bigint, total double, day bigint"
CARRIED = "uuid string, tick bigint, edge_id bigint"
#: Quantiles by which a sketch tells the deviations from its median.
POINTS = 1000


def rank_error(k: int = K) -> float:
    """The stated bound for one quantile of a sketch with parameter k, as a share of all values."""
    return 2.296 / k ** 0.9723


def deviation_error(k: int = K) -> float:
    """The bound for the median deviation: values on both sides of the median, told by so many quantiles."""
    return 2 * rank_error(k) + 1 / POINTS


def daily_sketches(speeds: DataFrame, k: int = K, day_ticks: int = DAY_TICKS) -> DataFrame:
    """edge_id, sketch, n, total, day from speeds (edge_id, tick, kmh); unknown speeds leave no trace."""
    known = speeds.where(F.col("kmh").isNotNull() & ~F.isnan("kmh"))
    return (known.groupBy("edge_id", F.floor(F.col("tick") / day_ticks).alias("day"))
            .agg(F.kll_sketch_agg_double("kmh", k).alias("sketch"), F.count(F.lit(1)).alias("n"),
                 F.sum("kmh").alias("total"))
            .select("edge_id", "sketch", "n", "total", "day"))


def last_points(positions: DataFrame) -> DataFrame:
    """uuid, tick, edge_id: where each vehicle was last, for the days that follow."""
    last = F.max(F.struct("tick", (-F.col("edge_id")).alias("edge")))
    return positions.groupBy("uuid").agg(last.alias("last")).select(
        "uuid", F.col("last.tick").alias("tick"), (-F.col("last.edge")).alias("edge_id"))


def add_days(path: str, positions: DataFrame, edges: DataFrame, carried: DataFrame | None = None,
             k: int = K, day_ticks: int = DAY_TICKS) -> None:
    """Sketch the speeds of whole days into the table at `path`, one folder per day.

    `carried`, the last points before those days, lets the first move of a vehicle count.
    A day that is written again replaces itself, so a repeated run changes nothing.
    """
    points = positions.select("uuid", "tick", "edge_id")
    if carried is not None:
        points = points.unionByName(carried.select("uuid", "tick", "edge_id"))
    # The carried points are no moves of these days: nothing comes before them.
    (daily_sketches(edge_speeds(points, edges), k, day_ticks).repartition("day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path)


def _quantiles(sketch: str, shares: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, shares)))


def merged(sketches: DataFrame) -> DataFrame:
    """edge_id, sketch, n, total over all days."""
    return sketches.groupBy("edge_id").agg(F.kll_merge_agg_double("sketch").alias("sketch"),
                                           F.sum("n").alias("n"), F.sum("total").alias("total"))


def sketched_bounds(sketches: DataFrame, k: float = 3.0, scale: float = MAD_SCALE) -> DataFrame:
    """edge_id, n, mean, median, mad, upper_threshold, lower_threshold, as of the exact mode.

    The median deviation is that of `POINTS` quantiles, which stand for equal shares of the values.
    """
    median = F.col("median")
    shares = [(i + 0.5) / POINTS for i in range(POINTS)]
    rows = merged(sketches).withColumns({
        "median": F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)), "values": _quantiles("sketch", shares)})
    off = F.array_sort(F.transform("values", lambda x: F.abs(x - median)))
    return rows.withColumn("mad", F.element_at(off, POINTS // 2) * scale).select(
        "edge_id", "n", (F.col("total") / F.col("n")).alias("mean"), "median", "mad",
        (median + k * F.col("mad")).alias("upper_threshold"), (median - k * F.col("mad")).alias("lower_threshold"))


def rank_errors(bounds: DataFrame, speeds: DataFrame, scale: float = MAD_SCALE) -> DataFrame:
    """edge_id, n, median_error, mad_error: how far the ranks are from one half, against all speeds.

    `speeds` (edge_id, kmh) are the exact ones. A value that many speeds share covers a range of ranks.
    """
    known = speeds.where(F.col("kmh").isNotNull() & ~F.isnan("kmh")).select("edge_id", "kmh")
    off = F.abs(F.col("kmh") - F.col("median"))
    # The deviation was told after arithmetic on it: the nearest value counts.
    raw, slack = F.col("mad") / scale, 1e-9 * (1 + F.abs(F.col("median")))
    share = lambda c: F.avg(c.cast("double"))
    half = F.lit(0.5)
    return (known.join(bounds.select("edge_id", "median", "mad"), "edge_id").groupBy("edge_id").agg(
        F.count(F.lit(1)).alias("n"), share(F.col("kmh") < F.col("median")).alias("below"),
        share(F.col("kmh") <= F.col("median")).alias("upto"),
        share(off < raw - slack).alias("nearer"), share(off <= raw + slack).alias("within"))
        .select("edge_id", "n",
                F.greatest(F.lit(0.0), F.col("below") - half, half - F.col("upto")).alias("median_error"),
                F.greatest(F.lit(0.0), F.col("nearer") - half, half - F.col("within")).alias("mad_error")))
