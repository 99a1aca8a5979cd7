"""Incremental sync of completed tasks and of yesterday's time entries."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from effortlens.functions.timeutil import day_start_utc, ntz_literal, parse_mark
from effortlens.operators import metrics, normalize, projects, scans, upsert
from effortlens.plans.current import fold_landing
from effortlens.plans.publish import DailyDigest, daily_digest
from effortlens.plans.warehouse import Landing, Warehouse
from effortlens.schema import figures_of
from effortlens.sources import landing as land
from effortlens.sources.quarantine import accepted
from effortlens.sources.tables import MergeResult


@dataclass(frozen=True)
class SyncOptions:
    project_filter: str | None = None
    full_sync: bool = False
    backfill_subtasks: bool = False
    include_incomplete_subtasks: bool = False
    completed_since: datetime | None = None
    date_jst: str | None = None
    # "modified" also catches edits to tasks completed before the cutoff.
    cutoff_by: str = "completed"

    def override(self) -> datetime | None:
        """Explicit cutoff, else the start of the given local day; a bad day is ignored."""
        if self.completed_since is not None or not self.date_jst:
            return self.completed_since
        try:
            return day_start_utc(datetime.strptime(self.date_jst, "%Y-%m-%d").date())
        except ValueError:
            return None


@dataclass(frozen=True)
class SyncOutcome:
    started_at: datetime
    tasks_processed: int
    errors: int
    cutoff: datetime
    merge: MergeResult


def sync_completed(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    run_ts: datetime,
    options: SyncOptions = SyncOptions(),
) -> SyncOutcome:
    """Bring the completed-task table up to date with what has been landed.

    Newly landed payloads are folded into the current tables first. A sync that goes on from
    the last one then takes what was first seen since: fresh parents with all their subtasks,
    and fresh subtasks of all parents that are open or past the cutoff, whenever these landed.
    Tasks of a project that was changed since count as fresh.
    """
    table = warehouse.completed(spark)
    _, last_run, mark = table.last_logged()
    needs_watermark = not (options.full_sync or options.backfill_subtasks)
    watermark = parse_mark(mark) if needs_watermark and mark else None
    cutoff = scans.completed_since_cutoff(
        watermark, options.override(), options.backfill_subtasks, options.full_sync
    )
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
        chosen = projects.named_like(known, options.project_filter)
        tasks = projects.of_projects(now.tasks, chosen)
        recent = scans.completed_since(tasks, cutoff, options.cutoff_by)
        if watermark is None or last_run is None:
            items = normalize.task_items(recent, now.subtasks)
        else:
            new = F.col("seen_at") >= ntz_literal(last_run)
            moved = projects.changed_since(chosen, last_run - timedelta(days=1))
            marked = recent.join(moved.withColumn("moved", F.lit(True)), "project_gid", "left")
            fresh = new | F.coalesce("moved", F.lit(False))
            items = normalize.fresh_items(marked, now.subtasks, fresh, new)
        made_from = normalize.completed_task_facts(items, options.include_incomplete_subtasks)
        seen = Observation("sync")
        batch = metrics.observed(made_from.withColumn("inserted_at", ntz_literal(run_ts)), seen)
        newest = upsert.latest_in_batch(batch)
        merged = table.merge(
            upsert.stage_batch(normalize.task_rows(newest), run_ts),
            upsert.merge_tasks,
            finish=upsert.backfill_minutes,
            stamp=run_ts,
        )
    figures = figures_of(seen, tasks_processed=0, errors=0)
    lost = now.malformed + now.keyless + listed.malformed + listed.keyless
    return SyncOutcome(
        run_ts, figures["tasks_processed"], figures["errors"] + lost, cutoff, merged
    )


def sync_time_entries(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    run_ts: datetime,
    first: date | None = None,
    last: date | None = None,
    user_gid: str | None = None,
    project_gid: str | None = None,
) -> MergeResult:
    """Replace the landed entries of a day range, by default of yesterday (local)."""
    first = first or scans.yesterday(run_ts)
    landed = scans.entries_between(
        land.read_time_entries(spark, landing.time_entries),
        first,
        last or first,
        user_gid,
        project_gid,
        keep=F.col(land.MALFORMED).isNotNull(),
    )
    aside = warehouse.quarantine(spark)
    with accepted(landed, "time_entries", ("gid",), aside, run_ts) as entries:
        batch = upsert.stage_entries(normalize.time_entry_rows(entries.rows), run_ts)
        merged = warehouse.entries(spark).merge(
            batch, lambda stored, new, small: upsert.replace_entries(stored, new)
        )
        lost = entries.malformed + entries.keyless
        return replace(merged, rejected=merged.rejected + lost)


@dataclass(frozen=True)
class NightlyRun:
    tasks: SyncOutcome
    entries: MergeResult | None
    entries_error: str | None
    digest: DailyDigest


def run_nightly(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    run_ts: datetime,
    options: SyncOptions = SyncOptions(),
    recluster: bool = False,
) -> NightlyRun:
    """The scheduled sync: tasks, yesterday's time entries, then yesterday's digest.

    Time entries that cannot be read or merged do not stop the run; why is reported.
    ``recluster`` also rewrites the task table in range order and fills the minute columns
    of months that no merge has touched.
    """
    tasks = sync_completed(spark, landing, warehouse, run_ts, options)
    if recluster:
        warehouse.completed(spark).rewrite(upsert.backfill_minutes)
    entries, problem = None, None
    if landing.time_entries:
        try:
            entries = sync_time_entries(spark, landing, warehouse, run_ts)
        except PySparkException as error:
            problem = str(error)
    digest = daily_digest(spark, warehouse, scans.yesterday(run_ts))
    return NightlyRun(tasks, entries, problem, digest)
