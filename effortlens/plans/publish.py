"""Reports, dimensions and digests from the stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from effortlens.functions.timeutil import local_today, month_bounds
from effortlens.operators import daily, dims, monthly, open_tasks, reports, weekly
from effortlens.operators.daily import BASELINE_REACH_DAYS
from effortlens.plans.effort import refresh_effort, stored_effort
from effortlens.plans.warehouse import Warehouse
from effortlens.sources.report_sink import publish_report
from effortlens.sources.tables import read_snapshots


def publish_reports(
    spark: SparkSession, warehouse: Warehouse, run_ts: datetime
) -> dict[str, bool]:
    """Write the three reports from the stored totals.

    Only months that merges have touched since the last time are read and aggregated again.
    """
    refresh_effort(spark, warehouse)
    effort = stored_effort(spark, warehouse)
    return {
        kind: publish_report(
            reports.report_from_effort(effort, kind), kind, warehouse.reports, run_ts
        )
        for kind in reports.REPORT_KEYS
    }


def seed_dimensions(spark: SparkSession, warehouse: Warehouse, run_ts: datetime) -> None:
    """Refresh the project and user dimensions from the latest task versions."""
    unique = warehouse.unique(spark)
    known = warehouse.projects(spark)
    known.replace(dims.upsert_projects(known.read(), unique, run_ts))
    people = warehouse.users(spark)
    people.replace(dims.upsert_users(people.read(), unique, run_ts))


@dataclass(frozen=True)
class MonthlyDigest:
    kpi: DataFrame
    top_projects: DataFrame
    top_assignees: DataFrame


def monthly_digest(
    spark: SparkSession, warehouse: Warehouse, month: str | None = None, n: int = 5
) -> MonthlyDigest:
    """Digest of a month, by default the latest that has completions.

    Which month that is stands in the names of folders, so one month is read either way.
    """
    month = month or warehouse.latest_month(spark)
    if month is None:
        unique = warehouse.unique(spark)
    else:
        first, following = month_bounds(month)
        unique = warehouse.unique(spark, first, following - timedelta(days=1))
    return MonthlyDigest(
        monthly.monthly_kpi(unique, month),
        monthly.top_projects(unique, month, n),
        monthly.top_assignees(unique, month, n),
    )


def is_monthly_digest_due(run_ts: datetime, forced: bool = False) -> bool:
    """The export sends the monthly digest on the first local day of a month."""
    return forced or local_today(run_ts).day == 1


@dataclass(frozen=True)
class ExportRun:
    published: dict[str, bool]
    digest: MonthlyDigest | None


def run_export(
    spark: SparkSession,
    warehouse: Warehouse,
    run_ts: datetime,
    month: str | None = None,
    send_digest: bool = False,
) -> ExportRun:
    """The scheduled export: the three reports, and the monthly digest when it is due."""
    published = publish_reports(spark, warehouse, run_ts)
    due = is_monthly_digest_due(run_ts, forced=send_digest)
    return ExportRun(published, monthly_digest(spark, warehouse, month) if due else None)


@dataclass(frozen=True)
class DailyDigest:
    summary: DataFrame
    top_projects: DataFrame
    top_assignees: DataFrame


def daily_digest(
    spark: SparkSession, warehouse: Warehouse, day: date, n: int = 5
) -> DailyDigest:
    """Digest of a day; reads the two or three months its baseline reaches into."""
    reach = min(day.replace(day=1), day - timedelta(days=BASELINE_REACH_DAYS))
    around = warehouse.unique(spark, reach, day)
    that_month = warehouse.unique(spark, day, day)
    return DailyDigest(
        daily.daily_digest(around, day),
        daily.top_projects(that_month, day, n),
        daily.top_assignees(that_month, day, n),
    )


@dataclass(frozen=True)
class OpenSummary:
    kpi: DataFrame
    top_projects: DataFrame
    top_assignees: DataFrame


def open_summary(
    spark: SparkSession, warehouse: Warehouse, day: date, n: int = 5
) -> OpenSummary:
    snapshots = read_snapshots(spark, warehouse.snapshots)
    return OpenSummary(
        open_tasks.open_kpi(snapshots, day),
        open_tasks.open_top_projects(snapshots, day, n),
        open_tasks.open_top_assignees(snapshots, day, n),
    )


@dataclass(frozen=True)
class WeeklyPlan:
    assignees: DataFrame
    project_overdue: DataFrame
    assignee_overdue: DataFrame
    due_unset: DataFrame


def weekly_plan(
    spark: SparkSession,
    warehouse: Warehouse,
    day: date,
    allowed: Sequence[str] | DataFrame,
    n: int = 10,
) -> WeeklyPlan:
    """Plan of the week of a snapshot day, from that day's partition only."""
    snapshots = read_snapshots(spark, warehouse.snapshots)
    return WeeklyPlan(
        weekly.assignee_plan(snapshots, day, allowed),
        weekly.project_overdue(snapshots, day, n),
        weekly.assignee_overdue(snapshots, day, allowed, n),
        weekly.due_unset(snapshots, day, allowed, n),
    )
