"""Starting streaming queries on Kafka, files or the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def with_trigger(writer, every: str | None):
    """`every` is an interval such as '1 seconds'; None drains what is there and stops."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str,
             every: str | None = "0 seconds") -> StreamingQuery:
    """Append the `value` column (and `key`, if any) to a topic."""
    writer = (messages.writeStream.format("kafka").outputMode("append")
              .option("kafka.bootstrap.servers", servers).option("topic", topic)
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, every).start()


def to_files(messages: DataFrame, path: str, checkpoint: str, file_format: str = "parquet",
             every: str | None = None) -> StreamingQuery:
    writer = (messages.writeStream.format(file_format).outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return with_trigger(writer, every).start()


def to_batches(rows: DataFrame, path: str, checkpoint: str, every: str | None = None,
               written: Callable[[int], None] | None = None) -> StreamingQuery:
    """Write each micro-batch to its own folder, which a repeated attempt replaces.

    Spark repeats a micro-batch, with the same rows, that failed before its commit. As the
    folder is named after the batch of this query, the rows are there once whenever it failed.
    `written` is called after the write and before the commit.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch_to(batch, None, "", path, batch_id)
        if written:
            written(batch_id)

    writer = rows.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def batch_to(messages: DataFrame, servers: str | None, topic: str, path: str | None,
             batch_id: int) -> None:
    """Write one micro-batch to a topic, or to its own folder below `path`."""
    if servers:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    else:
        messages.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def to_console(rows: DataFrame, checkpoint: str | None = None,
               every: str | None = "1 seconds", shown: int = 20) -> StreamingQuery:
    """Print the first `shown` rows of every micro-batch.

    All its rows are worked out, but only these come to the driver: Spark's own console sink
    collects the whole micro-batch there.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        line = "-" * 43
        print(f"{line}\nBatch: {batch_id}\n{line}")
        place = "_place_in_batch"
        (batch.withColumn(place, F.monotonically_increasing_id()).orderBy(place).drop(place)
         .show(shown, truncate=False))

    writer = rows.writeStream.outputMode("append").foreachBatch(handle)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def sign_records(signs: DataFrame) -> DataFrame:
    """routing_key, body -> key, value of a message sink."""
    return signs.select(F.col("routing_key").alias("key"), F.col("body").alias("value"))
