"""Weekly plan: work due this week, overdue work and open work without a due day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.functions.effort import remaining_minutes
from effortlens.operators.open_tasks import on_snapshot

UNASSIGNED = "(未割当)"  # fixed value


def week_start(day: Column) -> Column:
    return F.to_date(F.trunc(day, "week"))


def week_bounds(days: DataFrame, day: str = "day") -> DataFrame:
    """Monday and Sunday of the week of each day, as text."""
    monday = week_start(F.col(day))
    return days.withColumns(
        {"ws": monday.cast("string"), "we": F.date_add(monday, 6).cast("string")}
    )


def _week_of(day: date) -> tuple[date, date]:
    monday = day - timedelta(days=day.weekday())
    return monday, monday + timedelta(days=6)


def _of_allowed(
    rows: DataFrame, allowed: Sequence[str] | DataFrame, include_unassigned: bool
) -> DataFrame:
    """Rows of the allowed assignees under their trimmed name.

    Unassigned rows match no name and drop out unless they are asked for.
    """
    named = rows.withColumn("assignee_name", F.trim("assignee_name"))
    if isinstance(allowed, DataFrame):
        names = allowed.toDF("allowed_name").distinct()
        same = F.col("assignee_name") == F.col("allowed_name")
        chosen = named.join(names, same, "left_semi")
    else:
        chosen = named.filter(F.col("assignee_name").isin(sorted(set(allowed))))
    if include_unassigned:
        nobody = named.filter(F.coalesce(F.col("assignee_name"), F.lit("")) == "")
        chosen = chosen.filter(F.col("assignee_name") != "").unionByName(
            nobody.withColumn("assignee_name", F.lit(UNASSIGNED))
        )
    return chosen


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _remaining_if(condition: Column) -> Column:
    left = remaining_minutes(F.col("estimated_minutes"), F.col("actual_minutes"))
    return F.sum(F.when(condition, left).otherwise(F.lit(0.0)))


def assignee_plan(
    snapshots: DataFrame,
    day: date,
    allowed: Sequence[str] | DataFrame,
    include_unassigned: bool = False,
) -> DataFrame:
    """Per allowed assignee: due this week, and due before it, with remaining minutes."""
    monday, sunday = _week_of(day)
    this_week = F.col("due_on").between(F.lit(monday), F.lit(sunday))
    before = F.col("due_on") < F.lit(monday)
    rows = _of_allowed(on_snapshot(snapshots, day), allowed, include_unassigned)
    plan = rows.groupBy("assignee_name").agg(
        _count_if(this_week).alias("this_week_tasks"),
        _remaining_if(this_week).alias("this_week_remaining_minutes"),
        _count_if(before).alias("prev_overdue_tasks"),
        _remaining_if(before).alias("prev_overdue_remaining_minutes"),
    )
    return plan.orderBy(
        F.col("prev_overdue_remaining_minutes").desc(),
        F.col("this_week_remaining_minutes").desc(),
        F.col("assignee_name").asc(),
    )


def _top_matching(
    rows: DataFrame, name: str, condition: Column, tasks: str, minutes: str, n: int
) -> DataFrame:
    """The n names with the most remaining minutes among rows that meet a condition."""
    totals = rows.filter(condition).groupBy(name).agg(
        F.count(F.lit(1)).alias(tasks), _remaining_if(F.lit(True)).alias(minutes)
    )
    return totals.orderBy(F.col(minutes).desc(), F.col(name).asc_nulls_first()).limit(n)


def project_overdue(snapshots: DataFrame, day: date, n: int = 10) -> DataFrame:
    """Projects with overdue work, every assignee included."""
    return _top_matching(
        on_snapshot(snapshots, day),
        "project_name",
        F.col("is_overdue"),
        "overdue_tasks",
        "overdue_remaining_minutes",
        n,
    )


def assignee_overdue(
    snapshots: DataFrame,
    day: date,
    allowed: Sequence[str] | DataFrame,
    n: int = 10,
    include_unassigned: bool = False,
) -> DataFrame:
    """Allowed assignees with overdue work."""
    return _top_matching(
        _of_allowed(on_snapshot(snapshots, day), allowed, include_unassigned),
        "assignee_name",
        F.col("is_overdue"),
        "overdue_tasks",
        "overdue_remaining_minutes",
        n,
    )


def due_unset(
    snapshots: DataFrame,
    day: date,
    allowed: Sequence[str] | DataFrame,
    n: int = 10,
    include_unassigned: bool = False,
) -> DataFrame:
    """Allowed assignees with open work that has no due day."""
    return _top_matching(
        _of_allowed(on_snapshot(snapshots, day), allowed, include_unassigned),
        "assignee_name",
        F.col("due_on").isNull(),
        "due_unset_tasks",
        "due_unset_remaining_minutes",
        n,
    )
