"""Exact medians and median-absolute-deviation bounds of any group size.

`F.median` gathers a whole group in one task, which a hot key does not allow.
Here rows are first combined to (key, value, n), put in order of key and value
over all tasks, and written once together with the number of the task, the
slice. Counts per key and slice tell which slices of a key hold its middle; only
those rows are ranked. A hot key has many slices, of which two are looked at.
There is one plan for keys of all sizes and nothing is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.lookup import join_on
from roadpulse.session import settle

# Fixed value: makes the MAD of a normal distribution equal its standard deviation.
MAD_SCALE = 1.4826

_SLICE = "_slice"


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, n: how often each key holds each value."""
    return (df.groupBy(*keys, F.col(value).cast("double").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def sliced(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The counts in order of key and value over all tasks, with the task as `_slice`, settled.

    Rows of a key are cut by value; equal sizes of the slices are up to Spark's sampling.
    """
    return settle(counts.repartitionByRange(*keys, "value")
                  .withColumn(_SLICE, F.spark_partition_id()), "value-counts")


def _middle_ranks(total: Column) -> tuple[Column, Column]:
    return F.floor((total + 1) / 2), F.floor(total / 2) + 1


def weighted_median(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, median: the exact median of `value` with multiplicity `n`, from `sliced` counts.

    NULL and NaN values are ignored; a key with no other value is absent.
    """
    value = F.col("value")
    rows = counts.where(value.isNotNull() & ~F.isnan(value))
    whole = Window.partitionBy(*keys)
    low, high = _middle_ranks(F.col("total"))
    middle = (
        rows.groupBy(*keys, _SLICE).agg(F.sum("n").alias("size"))
        .withColumn("total", F.sum("size").over(whole))
        .withColumn("through", F.sum("size").over(
            whole.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("before", F.col("through") - F.col("size"))
        .where((F.col("through") >= low) & (F.col("before") < high))
        .select(*keys, _SLICE, "before", "total"))
    running = (Window.partitionBy(*keys, _SLICE).orderBy("value")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (join_on(rows, middle, [*keys, _SLICE])
              .withColumn("through", F.col("before") + F.sum("n").over(running)))
    found = [F.max(F.when((F.col("through") - F.col("n") < rank) & (F.col("through") >= rank),
                          value)) for rank in (low, high)]
    return ranked.groupBy(*keys).agg(((found[0] + found[1]) / 2).alias("median"))


def deviation_counts(counts: DataFrame, medians: DataFrame, keys: list[str]) -> DataFrame:
    """keys, value, n: the absolute deviations from each key's median."""
    return (join_on(counts, medians.select(*keys, "median"), keys)
            .withColumn("value", F.abs(F.col("value") - F.col("median")))
            .groupBy(*keys, "value").agg(F.sum("n").alias("n")))


def bounds_from_counts(counts: DataFrame, keys: list[str], k: float = 3.0,
                       scale: float = MAD_SCALE, single_precision: bool = False) -> DataFrame:
    """keys, n, mean, median, mad, upper_threshold, lower_threshold.

    A key whose values are all NULL keeps its row, with NULL bounds; so does a
    key holding a NaN, for which no bound can be told. `single_precision`
    rounds both medians to 32-bit floats.
    """
    rounded = (lambda c: c.cast("float").cast("double")) if single_precision else (lambda c: c)
    value, n = F.col("value"), F.col("n")
    counts = sliced(counts, keys)
    totals = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)).alias("n"),
        F.try_divide(F.sum(value * n), F.sum(F.when(value.isNotNull(), n))).alias("mean"),
        F.max(F.coalesce(F.isnan(value), F.lit(False))).alias("_nan"))
    medians = settle(join_on(totals, weighted_median(counts, keys), keys, "left")
                     .withColumn("median", rounded(F.col("median"))), "medians")
    off = sliced(deviation_counts(counts, medians, keys), keys)
    deviations = (weighted_median(off, keys)
                  .withColumn("mad", rounded(F.col("median")) * scale).drop("median"))
    known = lambda c: F.when(~F.col("_nan"), c)
    return join_on(medians, deviations, keys, "left").select(
        *keys, "n", "mean",
        known(F.col("median")).alias("median"),
        known(F.col("mad")).alias("mad"),
        known(F.col("median") + k * F.col("mad")).alias("upper_threshold"),
        known(F.col("median") - k * F.col("mad")).alias("lower_threshold"))


def mad_bounds(df: DataFrame, keys: list[str], value: str, k: float = 3.0,
               scale: float = MAD_SCALE, single_precision: bool = False) -> DataFrame:
    """Outlier bounds, median -/+ k * MAD, of one numeric column per key."""
    return bounds_from_counts(value_counts(df, keys, value), keys, k, scale, single_precision)


def deviations(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every input row with its key's median and its absolute deviation from it.

    The rows themselves take the place of an array of values per key, which
    would have to fit in one task.
    """
    counts = sliced(value_counts(df, keys, value), keys)
    return (join_on(df, weighted_median(counts, keys), keys, "left")
            .withColumn("deviation", F.abs(F.col(value) - F.col("median"))))
