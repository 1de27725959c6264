"""Graceful stop of a streaming query on a marker file, and what its batches cost."""

from __future__ import annotations

import time
from collections import deque

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from feederlens.sources.storage import delete, exists


class BatchListener(StreamingQueryListener):
    """Counts the batches that a query has ended, with the durations and input rows of the last ones."""

    def __init__(self, query: StreamingQuery | None = None, keep: int = 100):
        self.query = None if query is None else str(query.id)
        self.ended = self.rows = self.milliseconds = 0
        self.last: deque[tuple[int, int, int]] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        # An idle trigger reports no batch of its own.
        if self.query in (None, str(p.id)) and "addBatch" in p.durationMs:
            self.last.append((p.batchId, p.batchDuration, p.numInputRows))
            self.rows += p.numInputRows
            self.milliseconds += p.batchDuration
            self.ended += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_until_marker(
    spark: SparkSession, query: StreamingQuery, marker: str, poll_seconds: float = 10
) -> None:
    """Waits for the query; once the marker exists, lets the running batch finish, stops and removes
    the marker. Errors of the query are raised as usual.

    The running batch has finished when the listener has seen one more end, or when no trigger runs. With
    a backlog the next batch begins at once; it is given up, and the next start handles it again."""
    listener = BatchListener(query)
    spark.streams.addListener(listener)
    try:
        while not query.awaitTermination(poll_seconds):
            if exists(spark, marker):
                before = listener.ended
                while query.isActive and query.status["isTriggerActive"] and listener.ended == before:
                    time.sleep(min(poll_seconds, 0.05))
                query.stop()
                delete(spark, marker)
                return
    finally:
        spark.streams.removeListener(listener)
