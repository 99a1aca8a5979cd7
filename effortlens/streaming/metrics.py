"""Figures of every micro-batch of the task stream, stored as they are reported."""

from __future__ import annotations

import threading
import time
from contextlib import contextmanager
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from effortlens.sources import folders
from effortlens.streaming.incremental import WATCHERS

_ROW = (
    "query_id string, run_id string, batch_id long, started_at string, duration_ms long, "
    "input_rows long, tasks_processed long, errors long, refused long"
)


class BatchMetrics(StreamingQueryListener):
    """Adds one row to the metrics folder for each micro-batch that had rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: set[str] = set()  # runs whose last event has been seen
        self.failed: list[Exception] = []
        self.figures: dict[tuple[str, int], dict[str, int]] = {}
        self._seen = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        figures = self.figures.pop((str(progress.id), progress.batchId), None)
        if figures is None or not progress.numInputRows:
            return
        row = (
            str(progress.id),
            str(progress.runId),
            progress.batchId,
            progress.timestamp,
            progress.batchDuration,
            progress.numInputRows,
            figures["tasks_processed"],
            figures["errors"],
            figures["refused"],
        )
        try:
            rows = self.spark.createDataFrame([row], _ROW).coalesce(1)
            rows.write.mode("append").json(self.path)
        except Exception as error:  # an exception here would be lost in the listener's thread
            self.failed.append(error)

    def onQueryTerminated(self, event):
        with self._seen:
            self.ended.add(str(event.runId))
            self._seen.notify_all()

    def wait_for(self, run_id: str, seconds: float) -> None:
        """Return when all of a run's events have been taken in; they come in order."""
        until = time.monotonic() + seconds
        with self._seen:
            while run_id not in self.ended:
                if not self._seen.wait(until - time.monotonic()):
                    raise TimeoutError(f"the figures of run {run_id} have not all come in")
        if self.failed:
            raise self.failed[0]


@contextmanager
def stored_metrics(spark: SparkSession, path: str) -> Iterator[BatchMetrics]:
    """Store the figures of task streams that are started and end inside the context."""
    listener = BatchMetrics(spark, path)
    spark.streams.addListener(listener)
    WATCHERS.append(listener.figures)
    try:
        yield listener
    finally:
        WATCHERS[:] = [w for w in WATCHERS if w is not listener.figures]
        spark.streams.removeListener(listener)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch; of one that was replayed the last run's."""
    if not folders.names_in(spark, path):
        return spark.createDataFrame([], _ROW)
    last = Window.partitionBy("query_id", "batch_id").orderBy(F.col("started_at").desc(), "run_id")
    rows = spark.read.schema(_ROW).json(path).withColumn("place", F.row_number().over(last))
    return rows.filter("place = 1").drop("place")
