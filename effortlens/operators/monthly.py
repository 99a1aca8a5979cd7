"""Monthly digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from effortlens.functions.timeutil import (
    BUSINESS_ZONE,
    local_month,
    within_local_month,
)
from effortlens.operators.ranking import top_by_hours
from effortlens.operators.reports import effort_by, has_assignee


def latest_month(unique: DataFrame, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Month of the latest completion, one row."""
    latest = unique.agg(F.max("completed_at").alias("latest"))
    return latest.select(local_month(F.col("latest"), zone).alias("month"))


def in_month(unique: DataFrame, month: str, zone: str = BUSINESS_ZONE) -> DataFrame:
    return unique.filter(within_local_month(F.col("completed_at"), month, zone))


def monthly_kpi(
    unique: DataFrame, month: str | None = None, zone: str = BUSINESS_ZONE
) -> DataFrame:
    """Task count and hours of one month, always one row; sums are null without tasks."""
    if month is not None:
        unique = in_month(unique, month, zone)
    per_month = effort_by(unique, ["month"], zone)
    newest = per_month.agg(
        F.max("month").alias("month"),
        F.max_by(F.struct("tasks", "actual", "estimated"), "month").alias("of"),
    )
    return newest.select(
        (F.lit(month) if month is not None else F.col("month")).alias("month"),
        F.coalesce(F.col("of.tasks"), F.lit(0).cast("bigint")).alias("tasks_count"),
        (F.col("of.actual") / 60.0).alias("total_actual_hours"),
        (F.col("of.estimated") / 60.0).alias("total_estimated_hours"),
    )


def _top(unique: DataFrame, name: str, month: str | None, n: int, zone: str) -> DataFrame:
    if month is not None:
        return top_by_hours(in_month(unique, month, zone), name, n)
    return _top_of_latest_month(unique, name, n, zone)


def _top_of_latest_month(unique: DataFrame, name: str, n: int, zone: str) -> DataFrame:
    """Top list of the latest month without first asking which month that is.

    Totals per month and name are ranked newest month first, so the n best rows begin
    with those of the latest month; what remains of older months is dropped. Rows of
    nobody do count towards the latest month, behind the named ones.
    """
    unlisted = ~has_assignee() if name == "assignee_name" else F.lit(False)
    totals = effort_by(unique, ["month", name], zone).select(
        "month",
        name,
        "tasks",
        (F.col("actual") / 60.0).alias("hours"),
        F.coalesce(unlisted, F.lit(True)).alias("unlisted"),
    )
    by_hours = [F.col("hours").desc(), F.col(name).asc_nulls_first()]
    best = totals.orderBy(F.col("month").desc(), F.col("unlisted").asc(), *by_hours).limit(n)
    # At most n rows meet in this window.
    newest = F.max("month").over(Window.partitionBy())
    listed = best.withColumn("newest", newest).filter(
        (F.col("month") == F.col("newest")) & ~F.col("unlisted")
    )
    return listed.select(name, "tasks", "hours").orderBy(*by_hours)


def top_projects(
    unique: DataFrame, month: str | None = None, n: int = 5, zone: str = BUSINESS_ZONE
) -> DataFrame:
    """The n projects with the most hours in a month, by default the latest one."""
    return _top(unique, "project_name", month, n, zone)


def top_assignees(
    unique: DataFrame, month: str | None = None, n: int = 5, zone: str = BUSINESS_ZONE
) -> DataFrame:
    """The n assignees with the most hours in a month, by default the latest one."""
    return _top(unique, "assignee_name", month, n, zone)
