"""Shows what arrives on a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sinks.streams import to_console


def start_health_check(messages: DataFrame, every: str | None = "0 seconds") -> StreamingQuery:
    return to_console(messages.select("key", "value"), every=every)
