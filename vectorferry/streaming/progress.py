"""Progress of streams: one row per micro-batch, with seconds and records a second."""

from __future__ import annotations

from collections import deque
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

KEPT = 10_000

PROGRESS = ("query string, run string, batch_id bigint, at timestamp, rows bigint, seconds double, "
            "records_per_second double, state string, error string")


class ProgressLog(StreamingQueryListener):
    """Listens to all streams of a session and keeps the last ``kept`` events.

    ``spark.streams.addListener(log)``; afterwards ``log.rows(spark)``. A micro-batch has the
    state ``done``; the end of a query is ``ended`` or, with its error, ``failed``.
    """

    def __init__(self, kept: int = KEPT):
        self._events: deque[tuple] = deque(maxlen=kept)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seconds = p.batchDuration / 1000
        self._events.append((
            str(p.id), str(p.runId), p.batchId, datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")), p.numInputRows,
            seconds, p.numInputRows / seconds if seconds else None, "done", None))

    def onQueryTerminated(self, event) -> None:
        state = "failed" if event.exception else "ended"
        self._events.append((str(event.id), str(event.runId), None, None, None, None, None, state, event.exception))

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self._events), PROGRESS)
