"""What streams did, from the engine itself: progress of every micro-batch as rows, and the state they keep."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, name string, batch_id bigint, started_at timestamp, input_rows bigint, "
    "batch_ms bigint, state_rows bigint, state_bytes bigint, late_rows bigint, start_offset string, end_offset string"
)
# Rows that are held until they are written.
HELD = 200


class ProgressRows(StreamingQueryListener):
    """A listener that appends a row for every micro-batch of the session's streams to a Parquet folder.

    Rows are written every HELD batches, when a stream ends, and by :meth:`flush`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states, sources = p.stateOperators, p.sources
        row = (
            str(p.id), str(p.runId), p.name, p.batchId, _time(p.timestamp), p.numInputRows, p.batchDuration,
            sum(s.numRowsTotal for s in states), sum(s.memoryUsedBytes for s in states),
            sum(s.numRowsDroppedByWatermark for s in states),
            sources[0].startOffset if sources else None, sources[0].endOffset if sources else None,
        )
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= HELD
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended.add(str(event.runId))

    def flush(self) -> None:
        """Write what is held."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)


def _time(text: str):
    from datetime import datetime

    return datetime.fromisoformat(text.replace("Z", "+00:00"))


@contextmanager
def recorded(spark: SparkSession, path: str) -> Iterator[ProgressRows]:
    """Record the progress of all streams that run inside the block."""
    listener = ProgressRows(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
        listener.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The recorded rows; empty before the first micro-batch."""
    try:
        return spark.read.schema(PROGRESS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROGRESS)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """The state (key, value, partition_id) that a stream's last micro-batch left behind; of a named variable for
    operators that have several."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)
