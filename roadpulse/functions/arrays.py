"""Functions over an array that one row already holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def consecutive_pairs(points: Column) -> Column:
    """[a, b, c] -> [{a, b}, {b, c}]; a single point pairs with itself; [] stays empty."""
    firsts = F.when(F.size(points) == 1, points).otherwise(
        F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))))
    seconds = F.when(F.size(points) == 1, points).otherwise(
        F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))))
    return F.arrays_zip(firsts.alias("first"), seconds.alias("second"))


def absolute_deviations(values: Column, centre: Column) -> Column:
    """Distance of every element from `centre`."""
    return F.transform(values, lambda v: F.abs(v - centre))


def array_median(values: Column) -> Column:
    """Exact median of one row's array: the mean of its two middle elements."""
    kept = F.array_sort(F.filter(values, lambda v: v.isNotNull()))
    n = F.size(kept)
    low = F.element_at(kept, (F.floor((n + 1) / 2)).cast("int"))
    high = F.element_at(kept, (F.floor(n / 2) + 1).cast("int"))
    return F.when(n > 0, (low + high) / 2)
