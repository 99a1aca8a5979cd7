"""Summary of the open tasks held by one snapshot day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from effortlens.operators.ranking import top_by_count


def on_snapshot(snapshots: DataFrame, day: date) -> DataFrame:
    """Rows of one snapshot day, a partition filter on the stored table."""
    return snapshots.filter(F.col("snapshot_date") == F.lit(day))


def open_kpi(snapshots: DataFrame, day: date) -> DataFrame:
    """Open and overdue counts, one row; the overdue sum is null for an empty day."""
    overdue = F.when(F.col("is_overdue"), 1).otherwise(0).cast("bigint")
    return on_snapshot(snapshots, day).agg(
        F.count(F.lit(1)).alias("open_count"), F.sum(overdue).alias("overdue")
    )


def open_top_projects(snapshots: DataFrame, day: date, n: int = 5) -> DataFrame:
    return top_by_count(on_snapshot(snapshots, day), "project_name", n)


def open_top_assignees(snapshots: DataFrame, day: date, n: int = 5) -> DataFrame:
    return top_by_count(on_snapshot(snapshots, day), "assignee_name", n)
