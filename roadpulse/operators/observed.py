"""Numbers observed while rows pass by, so that counting them takes no pass of its own.

Spark adds up what a named observation sees in a plan once that plan has run. The rows
observed here are written (settled) by the same plan, and read from there afterwards. A
task that is repeated after the loss of an executor may be counted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roadpulse.functions.messages import json_fields, to_id, to_number
from roadpulse.operators.movement import REJECTED


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


class TrainingMetrics:
    """Points, rejects by reason, moves, and moves on edges that the road map lacks."""

    def __init__(self):
        self._positions, self._moves = Observation(), Observation()

    def positions(self, judged: DataFrame) -> DataFrame:
        """Observe points with their `reason`."""
        return judged.observe(
            self._positions, F.count(F.lit(1)).alias("points"),
            *(_count_if(F.col("reason") == r).alias(f"points with {r}") for r in REJECTED.values()))

    def moves(self, counts: DataFrame) -> DataFrame:
        """Observe (edge_id, value, n): how often each speed occurs; NULL on an unknown edge."""
        number = lambda c: F.coalesce(F.sum(c), F.lit(0))
        return counts.observe(self._moves, number(F.col("n")).alias("moves"),
                              number(F.when(F.col("value").isNull(), F.col("n"))).alias("moves on unknown edges"))

    def get(self) -> dict[str, int]:
        """All numbers; waits for the plans that were observed."""
        return {**self._positions.get, **self._moves.get}


def observe_speeds(messages: DataFrame, name: str = "speeds", value: str = "value") -> DataFrame:
    """Speed messages, observed under `name`: how many there are, and how many lack an edge or a speed.

    In a stream, each progress report holds the numbers of its micro-batch.
    """
    rest = [c for c in messages.columns if c != value]
    parsed = messages.select(*rest, F.col(value).alias(value), json_fields(["edge_id", "avg_speed"], value))
    edge, speed = to_id(F.col("edge_id")), to_number(F.col("avg_speed"))
    return parsed.observe(name, F.count(F.lit(1)).alias("messages"),
                          _count_if(edge.isNull()).alias("messages with no edge id"),
                          _count_if(edge.isNotNull() & speed.isNull()).alias("messages with no speed")
                          ).select(*messages.columns)
