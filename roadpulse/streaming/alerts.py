"""Anomaly detection on the speed stream, and sign messages for its anomalies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.detect import anomalies, anomaly_messages, parse_speeds
from roadpulse.operators.signs import (
    RADIUS_METRES,
    boards_near,
    locate_edges,
    parse_anomalies,
    rejected_anomalies,
    sign_rows,
)
from roadpulse.operators.observed import observe_speeds
from roadpulse.session import settle
from roadpulse.sinks.streams import sign_records, to_console, with_trigger


def detect(messages: DataFrame, model: DataFrame) -> DataFrame:
    """Speed messages -> anomalous speeds, by the model as it is when the query starts."""
    usable = settle(model.select("edge_id", "lower_threshold"), "model")
    return anomalies(parse_speeds(messages), usable)


def start_alerts(messages: DataFrame, model: DataFrame, send, checkpoint: str,
                 show_every: str | None = "1 seconds") -> tuple[StreamingQuery, StreamingQuery]:
    """Two queries over one detection: messages to `send`, rows to the console.

    `send(frame, checkpoint)` starts the first. Each keeps its own checkpoint,
    so neither sink waits for the other.
    """
    found = detect(messages, model)
    sent = send(anomaly_messages(found), f"{checkpoint}/messages")
    shown = to_console(found, f"{checkpoint}/console", every=show_every)
    return sent, shown


def start_fan_out(messages: DataFrame, model: DataFrame, sinks: list[Callable[[DataFrame, int], None]],
                  checkpoint: str, every: str | None = None) -> StreamingQuery:
    """One query over one detection for all sinks: each gets the anomalies (edge_text, edge_id,
    avg_speed) of every micro-batch, with its number.

    A micro-batch is read, parsed and joined with the model once; the anomalies are kept until
    all sinks have them, and released then. A sink that fails fails the batch, which is
    handed to all of them again, so they should replace what they wrote under its number. The
    progress reports hold the numbers of messages, and of those without edge or speed.
    """
    usable = settle(model.select("edge_id", "lower_threshold"), "model")

    def handle(batch: DataFrame, batch_id: int) -> None:
        found = anomalies(parse_speeds(batch), usable).persist()
        try:
            for sink in sinks:
                sink(found, batch_id)
        finally:
            found.unpersist()

    writer = (observe_speeds(messages).writeStream.outputMode("append").foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, every).start()


def signs(messages: DataFrame, edges: DataFrame, nodes: DataFrame, boards: DataFrame,
          radius: float = RADIUS_METRES, strict: bool = True) -> DataFrame:
    """Anomaly messages -> key, value of sign messages, one per board nearby."""
    # Every micro-batch reads these two; the road map and the geometry are done once.
    located = settle(locate_edges(edges, nodes), "located-edges")
    near = settle(boards_near(edges, nodes, boards, radius), "boards-near")
    return sign_records(sign_rows(parse_anomalies(messages), located, near, strict))


def rejected_signs(messages: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Anomaly messages -> value, edge_id, reason of those that lenient signs leave out."""
    map_edges = settle(edges.select("edge_id", "from_node", "to_node"), "edges")
    map_nodes = settle(nodes.select("node_id"), "nodes")
    return rejected_anomalies(parse_anomalies(messages), map_edges, map_nodes).select(
        "value", "edge_id", "reason")
