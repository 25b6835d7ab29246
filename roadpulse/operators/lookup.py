"""Key-value tables: unique keys, and joins of facts to them.

No join here carries a broadcast hint. Spark broadcasts a side only below
`spark.sql.autoBroadcastJoinThreshold` (by file size, or by measured size under
AQE); beyond it the join is a sort-merge join whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_write_wins(df: DataFrame, keys: list[str], position: str | Column) -> DataFrame:
    """One row per key: the one with the greatest position. Combines map-side."""
    position = F.col(position) if isinstance(position, str) else position
    values = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*values), position).alias("_last"))
            .select(*keys, "_last.*"))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL (NULL equals NULL), keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows whose reason is NULL, the others with a `reason` column)."""
    judged = df.withColumn("reason", reason)
    return (judged.where(F.col("reason").isNull()).drop("reason"),
            judged.where(F.col("reason").isNotNull()))
