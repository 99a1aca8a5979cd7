"""Where a deployment lands its payloads and keeps its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from effortlens.functions.timeutil import months_between
from effortlens.operators.views import unique_tasks
from effortlens.sources import tables
from effortlens.sources.tables import StoredTable


@dataclass(frozen=True)
class Landing:
    """Folders of JSON lines; ``subtasks`` only when they are landed apart."""

    projects: str
    tasks: str
    time_entries: str | None = None
    subtasks: str | None = None


@dataclass(frozen=True)
class Warehouse:
    """``buckets`` of each month, or of a table without months; fixed for a warehouse's life.

    Choose it so that a bucket of a large month is a few gigabytes: it is what a merge of a
    single row reads and writes again.
    """

    root: str
    buckets: int = 1

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _table(self, spark: SparkSession, name: str, layout: tables.Layout, buckets: int | None = None):
        return StoredTable(spark, self._path(name), layout, buckets or self.buckets)

    def completed(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "completed_tasks", tables.COMPLETED_TASKS)

    def entries(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "time_entries", tables.TIME_ENTRIES)

    def projects(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "dim_projects", tables.DIM_PROJECTS, 1)

    def users(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "dim_users", tables.DIM_USERS, 1)

    def current_tasks(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "current_tasks", tables.CURRENT_TASKS)

    def current_subtasks(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "current_subtasks", tables.CURRENT_SUBTASKS)

    def quarantine(self, spark: SparkSession) -> StoredTable:
        return self._table(spark, "quarantine", tables.QUARANTINE, 1)

    def latest_month(self, spark: SparkSession) -> str | None:
        """Newest month with completions, from the names of folders; nothing is read."""
        dated = [m for m in self.completed(spark).labels() if m != tables.UNDATED]
        return max(dated, default=None)

    @property
    def snapshots(self) -> str:
        return self._path("open_tasks_snapshot")

    @property
    def reports(self) -> str:
        return self._path("reports")

    @property
    def monthly_effort(self) -> str:
        return self._path("monthly_effort")

    @property
    def stream_metrics(self) -> str:
        return self._path("stream_metrics")

    def unique(self, spark: SparkSession, first=None, last=None) -> DataFrame:
        """Latest task versions; with days given, only the months they fall in are read.

        The stored table holds one row per task, so nothing has to be ranked.
        """
        months = months_between(first, last) if first is not None else None
        return unique_tasks(self.completed(spark).read(months), one_row_per_task=True)
