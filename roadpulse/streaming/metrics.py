"""Numbers observed by a stream, added up over its micro-batches."""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQueryListener


class Totals(StreamingQueryListener):
    """Adds up one observation of one query. Add it to `spark.streams` before the query starts."""

    def __init__(self, observation: str):
        self.observation, self.rows, self.numbers = observation, 0, {}
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.observation)
        if seen is None:
            return
        self.rows += event.progress.numInputRows
        for name, number in seen.asDict().items():
            self.numbers[name] = self.numbers.get(name, 0) + number

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def get(self, timeout: float = 60.0) -> dict[str, int]:
        """The sums once the query has ended and all its reports have come in."""
        if not self._ended.wait(timeout):
            raise TimeoutError("the query has not ended")
        return dict(self.numbers)
