"""Daily snapshot of open tasks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from effortlens import schema
from effortlens.functions.timeutil import local_today
from effortlens.operators import normalize, projects, scans
from effortlens.plans.current import fold_landing
from effortlens.plans.publish import WeeklyPlan, weekly_plan
from effortlens.plans.warehouse import Landing, Warehouse
from effortlens.sources import landing as land
from effortlens.sources.quarantine import accepted
from effortlens.sources.tables import append_snapshot


@dataclass(frozen=True)
class SnapshotOutcome:
    day: date
    rejected: int
    malformed: int


def take_snapshot(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    run_ts: datetime,
    as_of: date | None = None,
    idempotent: bool = False,
) -> SnapshotOutcome:
    """Store the open tasks of all active projects as of a local day, today by default.

    The same day stamps the rows and decides what is overdue. What is open now stands in the
    current tables, into which newly landed payloads are folded first; landed history is not
    read again.
    """
    as_of = as_of or local_today(run_ts)
    listing = accepted(
        land.read_projects(spark, landing.projects),
        "projects",
        ("gid",),
        warehouse.quarantine(spark),
        run_ts,
    )
    now = fold_landing(spark, landing, warehouse, run_ts)
    with listing as listed:
        known = projects.active_projects(scans.latest_payloads(listed.rows, "gid"))
        tasks = projects.of_projects(scans.still_open(now.tasks), known)
        items = normalize.task_items(tasks, now.subtasks)
        rows = normalize.snapshot_rows(normalize.open_task_rows(items), as_of, run_ts)
        offered = Observation("offered")
        keyed = schema.count_rejected(rows, schema.OPEN_TASKS_SNAPSHOT, offered)
        append_snapshot(keyed, warehouse.snapshots, idempotent, as_of)
    rejected = schema.figures_of(offered, rejected=0)["rejected"]
    keyless = now.keyless + listed.keyless + rejected
    return SnapshotOutcome(as_of, keyless, now.malformed + listed.malformed)


@dataclass(frozen=True)
class SnapshotRun:
    snapshot: SnapshotOutcome
    plan: WeeklyPlan


def run_snapshot(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    run_ts: datetime,
    allowed: Sequence[str] | DataFrame,
    as_of: date | None = None,
    idempotent: bool = False,
) -> SnapshotRun:
    """The scheduled snapshot: open tasks stored, then the plan of their week."""
    taken = take_snapshot(spark, landing, warehouse, run_ts, as_of, idempotent)
    return SnapshotRun(taken, weekly_plan(spark, warehouse, taken.day, allowed))
