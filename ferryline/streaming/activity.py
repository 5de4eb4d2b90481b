"""Log rows written by the streams themselves: what their listener hears of every micro-batch.

The rows have the columns that the operators on worker logs read (``worker_stats``, ``batch_latency``), and the messages
and errors that the stream observed while it handled the micro-batch.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.listener import StreamingQueryListener

from ferryline.streaming.running import run_available

HANDLED = "handled"
LOG = "seq bigint, worker_no int, consumer_type string, type string, event_ts timestamp_ntz, processing_ms bigint, " \
    "messages bigint, errors bigint"


class ActivityLog(StreamingQueryListener):
    """One row when a stream starts, one for each micro-batch that had input, and one when it ends.

    Follows the stream that is started while it listens; rows are as many as micro-batches, and :meth:`rows` takes them
    out, so that a long-running stream can store them from time to time.
    """

    def __init__(self, worker_no: int, consumer_type: str):
        self.worker_no, self.consumer_type = worker_no, consumer_type
        self.ended = threading.Event()
        self._rows: list[tuple] = []
        self._lock, self._count, self._query = threading.Lock(), 0, None

    def _add(self, kind: str, at: datetime, ms: int | None = None, messages: int = 0, errors: int = 0) -> None:
        with self._lock:
            self._count += 1
            self._rows.append((self._count, self.worker_no, self.consumer_type, kind, at, ms, messages, errors))

    def onQueryStarted(self, event) -> None:
        if self._query is None:
            self._query = event.id
            self._add("ready", _time(event.timestamp))

    def onQueryProgress(self, event) -> None:
        told = event.progress
        if told.id == self._query and told.numInputRows:
            seen = told.observedMetrics.get(HANDLED)
            self._add("messageProcessed", _time(told.timestamp), int(told.batchDuration),
                      seen["messages"] if seen else 0, seen["errors"] if seen else 0)

    def onQueryIdle(self, event) -> None:
        """Nothing was handled."""

    def onQueryTerminated(self, event) -> None:
        if event.id == self._query:
            with self._lock:
                last = self._rows[-1][4] if self._rows else datetime(1970, 1, 1)
            self._add("error" if event.exception else "exit", last)
            self.ended.set()

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows so far, as a table; the next call starts behind them."""
        with self._lock:
            taken, self._rows = self._rows, []
        return spark.createDataFrame(taken, LOG)


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)


def observed(stream: DataFrame, failed: Column) -> DataFrame:
    """``stream`` with its messages and errors counted on the way, micro-batch by micro-batch."""
    return stream.observe(HANDLED, F.count(F.lit(1)).alias("messages"), F.count_if(failed).alias("errors"))


def run_logged(spark: SparkSession, writer: DataStreamWriter, checkpoint: str, worker_no: int, consumer_type: str) -> DataFrame:
    """:func:`run_available`, and the log that the stream wrote; an error of the stream is raised after its row is there."""
    log = ActivityLog(worker_no, consumer_type)
    spark.streams.addListener(log)
    try:
        run_available(spark, writer, checkpoint)
        log.ended.wait(60)  # the listener hears of the end a moment later
    finally:
        spark.streams.removeListener(log)
    return log.rows(spark)


def activity(log: DataFrame) -> DataFrame:
    """Messages, errors and time spent per worker, from the rows of :class:`ActivityLog`."""
    return log.where(F.col("type") == "messageProcessed").groupBy("worker_no", "consumer_type").agg(
        F.sum("messages").alias("messages"), F.sum("errors").alias("errors"), F.count(F.lit(1)).alias("batches"),
        F.sum("processing_ms").alias("busy_ms"))
