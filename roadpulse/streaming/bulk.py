"""The keyed speed rule on large micro-batches, each replayed as a batch; for backfills.

A micro-batch goes through `roadpulse.operators.replay`, which stays in the JVM and
divides the points of a hot vehicle among tasks. The state, one tick per vehicle, is one
table per micro-batch, joined and written anew by Spark. Running streams use Spark's keyed
state (`roadpulse.streaming.speeds`), which touches only the vehicles that arrive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.replay import last_ticks, replay_speeds
from roadpulse.session import delete, scratch, settle
from roadpulse.sinks.streams import with_trigger

STATE = "uuid string, tick bigint"


def start_bulk_speeds(positions: DataFrame, edges: DataFrame, state: str,
                      write: Callable[[DataFrame, int], None], checkpoint: str,
                      every: str | None = None,
                      start: DataFrame | None = None) -> StreamingQuery:
    """Hand the accepted speeds of each micro-batch to `write(speeds, batch_id)`.

    `state` is a folder for the last tick of every vehicle after each batch, which belongs to
    the checkpoint; that of the batch before last goes. A repeated batch starts from the same
    state; `write` should replace what an earlier attempt at the same batch wrote. `start`
    (uuid, tick) is the state before the first batch, if any.
    """
    spark = edges.sparkSession
    lengths = settle(edges.select("edge_id", "length"), "lengths")

    def after(batch_id: int) -> str:
        return f"{state}/batch={batch_id}"

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            # On in the caller's session: a stream's own runs without adaptive execution.
            points = settle(batch.select("uuid", "seq", "tick", "edge_id"), "points", spark)
            held = start if batch_id == 0 else spark.read.schema(STATE).parquet(after(batch_id - 1))
            write(replay_speeds(points, lengths, held=held), batch_id)
            last_ticks(points, lengths, held=held).write.mode("overwrite").parquet(after(batch_id))
        delete(spark, after(batch_id - 2))

    writer = (positions.writeStream.outputMode("append").foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, every).start()
