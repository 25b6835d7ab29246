"""Speeds from a position stream, with one remembered tick per vehicle."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadpulse.functions.messages import speed_message
from roadpulse.session import settle

SPEEDS = "uuid string, seq bigint, tick bigint, edge_id bigint, avg_speed double"


class LastTick(StatefulProcessor):
    """Turns a vehicle's points into speeds of the edges it reaches.

    - the first point is only remembered;
    - an advancing point on a known edge gives a speed and is remembered;
    - an advancing point on an unknown edge is passed over, the state stays;
    - a late or repeated point gives nothing, but is remembered.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._tick = handle.getValueState("tick", "tick bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._tick.get()
        tick = before = held[0] if held else None
        # The shuffle keeps no order; a trigger's size bounds what is sorted.
        for point in sorted(rows, key=lambda r: r.seq):
            advances = tick is not None and point.tick > tick
            if advances and point.length is None:
                continue
            if advances:
                yield Row(uuid=key[0], seq=point.seq, tick=point.tick, edge_id=point.edge_id,
                          avg_speed=point.length / (point.tick - tick))
            tick = point.tick
        if tick != before:
            self._tick.update((tick,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._tick.update((initialState.tick,))

    def close(self) -> None:
        pass


def speed_stream(positions: DataFrame, edges: DataFrame,
                 last_ticks: DataFrame | None = None) -> DataFrame:
    """Streaming uuid, seq, tick, edge_id -> accepted speeds.

    `last_ticks` (uuid, tick), e.g. from `roadpulse.operators.replay`, is where
    the first run starts from. Needs the RocksDB state store
    (`roadpulse.session.DEFAULTS`).
    """
    # Every micro-batch reads the lengths; the road map is parsed once.
    lengths = settle(edges.select("edge_id", "length"), "lengths")
    located = positions.join(lengths, "edge_id", "left")
    return located.groupBy("uuid").transformWithState(
        statefulProcessor=LastTick(), outputStructType=SPEEDS,
        outputMode="Append", timeMode="None",
        initialState=last_ticks.groupBy("uuid") if last_ticks is not None else None)


def held_ticks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """uuid, tick: the state a speed stream left in its checkpoint, as Spark's state reader gives it.

    Another query starts from it (`last_ticks` of `speed_stream`), e.g. one with
    another number of partitions, another road map or another source.
    """
    state = spark.read.format("statestore").option("stateVarName", "tick").load(checkpoint)
    return state.select("key.uuid", "value.tick")


def speed_records(speeds: DataFrame) -> DataFrame:
    """Speed rows as message values."""
    return speeds.select(speed_message(F.col("edge_id"), F.col("avg_speed")).alias("value"))
