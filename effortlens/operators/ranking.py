"""Top-n lists shared by the digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from effortlens.operators.reports import has_assignee, minute_sum


def top_by_hours(unique: DataFrame, name: str, n: int) -> DataFrame:
    """The n names with the most actual hours; equal hours are ordered by name."""
    if name == "assignee_name":
        unique = unique.filter(has_assignee())
    totals = unique.groupBy(name).agg(
        F.count("task_id").alias("tasks"),
        (minute_sum("actual_minutes") / 60.0).alias("hours"),
    )
    return totals.orderBy(F.col("hours").desc(), F.col(name).asc_nulls_first()).limit(n)


def top_by_count(rows: DataFrame, name: str, n: int) -> DataFrame:
    """The n names with the most rows; equal counts are ordered by name."""
    if name == "assignee_name":
        rows = rows.filter(has_assignee())
    totals = rows.groupBy(name).agg(F.count(F.lit(1)).alias("cnt"))
    return totals.orderBy(F.col("cnt").desc(), F.col(name).asc_nulls_first()).limit(n)
