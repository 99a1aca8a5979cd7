"""Latest version of each completed task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from effortlens.functions.timeutil import BUSINESS_ZONE, local_day

VIEW_COLUMNS = [
    "task_id",
    "task_name",
    "parent_task_id",
    "project_name",
    "project_gid",
    "assignee_name",
    "assignee_gid",
    "completed_at",
    "modified_at",
    "inserted_at",
    "estimated_time",
    "actual_time",
    "actual_time_raw",
    "estimated_minutes",
    "actual_minutes",
    "is_subtask",
]


def newest_first(*leading: Column) -> list[Column]:
    """Version order: the given keys newest first, then names so that no tie is left open."""
    return [
        *[key.desc_nulls_last() for key in leading],
        F.coalesce(F.col("project_gid"), F.lit("")).asc(),
        F.coalesce(F.col("assignee_gid"), F.lit("")).asc(),
        F.coalesce(F.col("task_name"), F.lit("")).asc(),
    ]


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps only the first row per key of each map task before it shuffles, so a
    key with very many versions reaches its reducer as one row per map task.
    """
    ranked = df.withColumn(
        "version_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.filter(F.col("version_rank") == 1).drop("version_rank")


def unique_tasks(completed_tasks: DataFrame, one_row_per_task: bool = False) -> DataFrame:
    """Latest version of every task that has a completion instant.

    Pass ``one_row_per_task=True`` for a table kept by the upsert, which never holds
    two rows of a task: the view is then a plain projection, and later filters reach
    the scan instead of stopping at the version ranking.
    """
    done = completed_tasks.filter(F.col("completed_at").isNotNull())
    trimmed = done.withColumn("project_name", F.trim("project_name"))
    if not one_row_per_task:
        order = newest_first(F.col("modified_at"), F.col("inserted_at"))
        trimmed = first_per_key(trimmed, "task_id", order)
    return trimmed.select(*VIEW_COLUMNS)


def unique_tasks_daily(unique: DataFrame, zone: str = BUSINESS_ZONE) -> DataFrame:
    """The latest versions with their completion day in the business zone."""
    return unique.select(
        "task_id",
        "project_name",
        "project_gid",
        "assignee_name",
        "assignee_gid",
        local_day(F.col("completed_at"), zone).alias("completed_date_jst"),
        "estimated_minutes",
        "actual_minutes",
    )
