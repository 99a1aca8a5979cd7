"""Monthly effort by project, by assignee and by both."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.functions.timeutil import BUSINESS_ZONE, local_month_start, month_text

# Names of the three outputs and their column headers.
OUTPUT_NAMES = {
    "project": "プロジェクト別実績時間",
    "assignee": "担当者別実績時間",
    "project_assignee": "プロジェクト担当者別実績時間",
}
HEADERS = {
    "month": "対象期間",
    "project_name": "プロジェクト名",
    "assignee_name": "担当者名",
    "tasks_count": "完了タスク数",
    "total_actual_hours": "合計実績時間",
    "total_estimated_hours": "合計見積時間",
    "updated_at": "最終更新日時",
}
STAMP_FORMAT = "%Y-%m-%d %H:%M:%S"

REPORT_KEYS = {
    "project": ["month", "project_name"],
    "assignee": ["month", "assignee_name"],
    "project_assignee": ["month", "project_name", "assignee_name"],
}


def has_assignee() -> Column:
    return F.col("assignee_name").isNotNull() & (F.col("assignee_name") != "")


def minute_sum(column: str) -> Column:
    """Sum of minutes, an absent value counting as zero.

    Hours are taken from the finished sum: whole minutes add up exactly in any order,
    their sixtieths do not.
    """
    return F.sum(F.coalesce(F.col(column), F.lit(0.0)))


def effort_by(unique: DataFrame, keys: list[str], zone: str = BUSINESS_ZONE) -> DataFrame:
    """Task counts and minute totals per key; ``month`` is the local completion month.

    Rows are grouped by the first day of the month and only the groups get its text.
    """
    totals = (
        unique.withColumn("month", local_month_start(F.col("completed_at"), zone))
        .groupBy(*keys)
        .agg(
            F.count("task_id").alias("tasks"),
            minute_sum("actual_minutes").alias("actual"),
            minute_sum("estimated_minutes").alias("estimated"),
        )
    )
    return totals.withColumn("month", month_text(F.col("month")))


def monthly_effort(unique: DataFrame, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Finest totals; all three reports roll up from them."""
    return effort_by(unique, REPORT_KEYS["project_assignee"], zone)


def report(unique: DataFrame, kind: str, zone: str = BUSINESS_ZONE) -> DataFrame:
    """One report straight from the task versions."""
    if "assignee_name" in REPORT_KEYS[kind]:
        unique = unique.filter(has_assignee())
    return _report_form(effort_by(unique, REPORT_KEYS[kind], zone), kind)


def report_from_effort(effort: DataFrame, kind: str) -> DataFrame:
    """One report rolled up from the finest totals, for runs that want several."""
    if "assignee_name" in REPORT_KEYS[kind]:
        effort = effort.filter(has_assignee())
    totals = effort.groupBy(*REPORT_KEYS[kind]).agg(
        *[F.sum(c).alias(c) for c in ("tasks", "actual", "estimated")]
    )
    return _report_form(totals, kind)


def _report_form(totals: DataFrame, kind: str) -> DataFrame:
    by_hours = F.col("total_actual_hours").desc()
    by_name = [F.col(c).asc_nulls_first() for c in REPORT_KEYS[kind][1:]]
    if kind == "project_assignee":
        order = [by_name[0], by_hours, by_name[1]]
    else:
        order = [by_hours, *by_name]
    return totals.select(
        *REPORT_KEYS[kind],
        F.col("tasks").alias("tasks_count"),
        (F.col("actual") / 60.0).alias("total_actual_hours"),
        (F.col("estimated") / 60.0).alias("total_estimated_hours"),
    ).orderBy(F.col("month").desc(), *order)


def sheet(report_rows: DataFrame, updated_at: datetime) -> DataFrame:
    """A report as it is published: localised headers, rounded hours, refresh stamp."""

    def hours(name: str) -> Column:
        return F.round(F.coalesce(F.col(name), F.lit(0.0)), 2)

    published = report_rows.withColumns(
        {
            "total_actual_hours": hours("total_actual_hours"),
            "total_estimated_hours": hours("total_estimated_hours"),
            "updated_at": F.lit(updated_at.strftime(STAMP_FORMAT)),
        }
    )
    return published.select(
        *[F.col(c).alias(header) for c, header in HEADERS.items() if c in published.columns]
    )
