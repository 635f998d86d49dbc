"""Several streaming queries as one job, and a record of what their watermarks dropped."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from bourse.session import write_small_file


class QueryFailed(RuntimeError):
    """A supervised query ended with an error; ``query`` is its name or id."""

    def __init__(self, query: str, cause: Exception):
        super().__init__(f"streaming query {query} failed: {cause}")
        self.query = query


def supervise(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until all ``queries`` have ended; whichever fails first stops the others and is raised.

    Returns False if ``timeout`` seconds passed before (the queries then go on).  A query that
    ends without an error, as ``availableNow`` does, leaves the others running.
    """
    waiting, streams = list(queries), spark.streams
    until = None if timeout is None else time.monotonic() + timeout
    while waiting:
        for q in list(waiting):
            if q.isActive:
                continue
            waiting.remove(q)
            error = q.exception()
            if error is not None:
                for other in waiting:
                    other.stop()
                raise QueryFailed(q.name or str(q.id), error) from error
        if not waiting:
            return True
        streams.resetTerminated()
        if not all(q.isActive for q in waiting):  # one ended while the record was cleared
            continue
        rest = None if until is None else until - time.monotonic()
        if rest is not None and rest <= 0:
            return False
        try:
            # returns, or raises, as soon as any query of the session ends; the loop finds out which
            streams.awaitAnyTermination(1 if rest is None else min(rest, 1))
        except Exception:  # noqa: BLE001  the failed query's own exception is read above
            pass
    return True


class ProgressLog(StreamingQueryListener):
    """Writes one JSON line per micro-batch of one query to ``path``; a batch that runs again replaces its line.

    Columns: query, batch_id, input_rows, late_rows (rows that stateful operators dropped as older than the
    watermark; a sliding window counts a row once per window), state_rows, watermark.
    """

    def __init__(self, spark: SparkSession, path: str, query_name: str):
        self.spark, self.path, self.query_name = spark, path.rstrip("/"), query_name
        self.run_id, self.ended = None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.query_name:
            return
        state = p.stateOperators
        line = {
            "query": p.name,
            "batch_id": p.batchId,
            "input_rows": p.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in state),
            "state_rows": sum(s.numRowsTotal for s in state),
            "watermark": dict(p.eventTime).get("watermark"),
        }
        write_small_file(self.spark, f"{self.path}/batch-{p.batchId:012d}.json", json.dumps(line) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()

    def close(self, timeout: float = 60) -> None:
        """Wait for the lines of a query that has ended (events come a little later), then stop listening."""
        self.ended.wait(timeout)
        self.spark.streams.removeListener(self)


def log_progress(spark: SparkSession, path: str, query_name: str) -> ProgressLog:
    """Start a ``ProgressLog``; call it before the query of that name starts."""
    log = ProgressLog(spark, path, query_name)
    spark.streams.addListener(log)
    return log


METRICS = "query string, batch_id long, input_rows long, late_rows long, state_rows long, watermark string"


def read_metrics(spark: SparkSession, path: str):
    """The lines of a ``ProgressLog``."""
    return spark.read.schema(METRICS).json(path)
