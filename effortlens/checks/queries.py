"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.checks import fixtures as fx
from effortlens.functions.effort import (
    actual_from,
    duration_minutes,
    estimate_from,
    label_from_hours,
    label_from_minutes,
    readable_fields,
)
from effortlens.functions.timeutil import local_day_start, ntz_literal
from effortlens.operators import (
    audit,
    daily,
    dims,
    metrics,
    monthly,
    normalize,
    projects,
    reports,
    scans,
    upsert,
    views,
    weekly,
)
from effortlens.operators import open_tasks as open_digest
from effortlens.plans import publish
from effortlens.plans.effort import refresh_effort, stored_effort
from effortlens.plans.snapshot import take_snapshot
from effortlens.plans.warehouse import Warehouse
from effortlens.plans.sync import SyncOptions, sync_completed, sync_time_entries
from effortlens.sources import landing as land
from effortlens.sources.report_sink import publish_report, read_report
from effortlens.sources.tables import COMPLETED_TASKS, StoredTable, append_snapshot, read_snapshots
from effortlens.streaming.incremental import task_upsert_stream
from effortlens.streaming.metrics import read_metrics, stored_metrics

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.unique_tasks(fx.completed_tasks(spark, sf_dir))


def _items(spark: SparkSession, sf_dir: str, tasks: DataFrame) -> DataFrame:
    return normalize.task_items(tasks, fx.subtask_payloads(spark, sf_dir))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.open_snapshot(spark, sf_dir).withColumn(
        "has_time_fields",
        normalize.has_effort(F.col("estimated_minutes"), F.col("actual_minutes")),
    )
    return normalize.snapshot_rows(rows, fx.AS_OF, datetime(1998, 6, 17, 7))


def _six_decimals(df: DataFrame, *columns: str) -> DataFrame:
    """Sums in another order differ in their last digits; compared values leave these off."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _audited(df: DataFrame) -> DataFrame:
    return _six_decimals(df, "total_actual_hours")


# Sources and normalisation


@_query
def active_projects(spark, sf_dir):
    return projects.active_projects(fx.projects(spark, sf_dir)).select("gid", "name")


@_query
def project_filter(spark, sf_dir):
    listed = projects.active_projects(fx.projects(spark, sf_dir))
    return projects.named_like(listed, "Project 1").select("gid", "name")


@_query
def project_directory(spark, sf_dir):
    return projects.project_directory(fx.projects(spark, sf_dir))


@_query
def project_tasks(spark, sf_dir):
    listed = projects.active_projects(fx.projects(spark, sf_dir))
    tasks = projects.of_projects(fx.task_payloads(spark, sf_dir), listed)
    return tasks.groupBy("project_gid").agg(F.count("gid").alias("tasks"))


@_query
def sync_watermark(spark, sf_dir):
    return scans.sync_watermark(fx.raw_tasks(spark, sf_dir, ["modified_at"]))


@_query
def jst_day_start(spark, sf_dir):
    day = F.to_date("o_orderdate").cast("string")
    given = F.when(F.col("o_orderkey") % 13 == 0, F.concat(day, F.lit("T00"))).otherwise(day)
    dates = fx.table(spark, sf_dir, "orders").select("o_orderkey", given.alias("date_jst"))
    return dates.withColumn("start_utc", local_day_start(F.col("date_jst")))


@_query
def completed_since_scan(spark, sf_dir):
    tasks = scans.completed_since(fx.task_payloads(spark, sf_dir), fx.CUTOFF)
    return tasks.select("gid", "completed", "completed_at")


@_query
def modified_since_scan(spark, sf_dir):
    tasks = scans.completed_since(fx.task_payloads(spark, sf_dir), fx.CUTOFF, by="modified")
    return tasks.select("gid", "completed", "modified_at")


@_query
def completed_tasks_flat(spark, sf_dir):
    items = _items(spark, sf_dir, fx.task_payloads(spark, sf_dir))
    return normalize.completed_task_rows(items)


@_query
def completed_tasks_with_incomplete_subtasks(spark, sf_dir):
    items = _items(spark, sf_dir, fx.task_payloads(spark, sf_dir))
    return normalize.completed_task_rows(items, include_incomplete_subtasks=True)


@_query
def open_tasks(spark, sf_dir):
    tasks = scans.still_open(fx.task_payloads(spark, sf_dir))
    return normalize.open_task_rows(_items(spark, sf_dir, tasks))


@_query
def open_tasks_overdue(spark, sf_dir):
    tasks = scans.still_open(fx.task_payloads(spark, sf_dir))
    rows = normalize.open_task_rows(_items(spark, sf_dir, tasks))
    return normalize.snapshot_rows(rows, fx.AS_OF, datetime(1998, 6, 17, 7))


@_query
def duration_parse(spark, sf_dir):
    first = F.col("custom_fields")[0]
    return fx.task_payloads(spark, sf_dir).select(
        "gid",
        duration_minutes(
            first["number_value"], first["text_value"], first["display_value"]
        ).alias("minutes"),
    )


@_query
def duration_parse_prose(spark, sf_dir):
    """The same parser over whole free-form texts, most of which hold no duration."""
    text = F.col("text")
    nothing = F.lit(None)
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        duration_minutes(nothing.cast("double"), text, nothing.cast("string")).alias("minutes"),
    )


@_query
def custom_field_effort(spark, sf_dir):
    readable = fx.task_payloads(spark, sf_dir).select(
        "gid",
        "actual_time_minutes",
        readable_fields(F.col("custom_fields")).alias("readable"),
    )
    raw = F.coalesce(F.col("actual_time_minutes"), actual_from(F.col("readable")))
    return readable.select(
        "gid",
        estimate_from(F.col("readable")).alias("estimated_time"),
        (raw / 60.0).alias("actual_time"),
        raw.alias("actual_time_raw"),
    )


@_query
def time_entries_range(spark, sf_dir):
    entries = scans.entries_between(fx.time_entry_payloads(spark, sf_dir), *fx.ENTRY_DAYS)
    return entries.select("gid", "entered_on", "duration_minutes")


@_query
def time_entries_of_project(spark, sf_dir):
    entries = scans.entries_between(
        fx.time_entry_payloads(spark, sf_dir), *fx.ENTRY_DAYS, project_gid="P3"
    )
    return entries.select("gid", "entered_on", "duration_minutes")


@_query
def time_entries_yesterday(spark, sf_dir):
    day = scans.yesterday(datetime(2024, 1, 9, 20))
    entries = scans.entries_between(fx.time_entry_payloads(spark, sf_dir), day, day)
    return entries.select("gid", "entered_on", "duration_minutes")


@_query
def time_entries_flat(spark, sf_dir):
    return normalize.time_entry_rows(fx.time_entry_payloads(spark, sf_dir))


# Writes


@_query
def stage_batch(spark, sf_dir):
    items = _items(spark, sf_dir, fx.task_payloads(spark, sf_dir))
    return upsert.stage_batch(normalize.completed_task_rows(items), fx.RUN_TS)


@_query
def batch_dedup(spark, sf_dir):
    return upsert.latest_in_batch(fx.raw_tasks(spark, sf_dir))


@_query
def merge_upsert(spark, sf_dir):
    raw = fx.raw_tasks(spark, sf_dir)
    split = ntz_literal(fx.MERGE_SPLIT)
    target = upsert.latest_in_batch(raw.filter(F.col("modified_at") < split))
    batch = upsert.latest_in_batch(raw.filter(F.col("modified_at") >= split))
    return upsert.merge_tasks(target, batch)


@_query
def stored_merge(spark, sf_dir):
    """The same merge through a stored table: target and batch as two merges."""
    raw = fx.raw_tasks(spark, sf_dir)
    split = ntz_literal(fx.MERGE_SPLIT)
    table = StoredTable(spark, fx.scratch(spark), COMPLETED_TASKS)
    for part in (raw.filter(F.col("modified_at") < split), raw.filter(F.col("modified_at") >= split)):
        table.merge(upsert.latest_in_batch(part), upsert.merge_tasks)
    return table.read().select(*[f.name for f in schema.COMPLETED_TASKS])


@_query
def streamed_upsert(spark, sf_dir):
    """Orders and their lines streamed into a stored table; returns what it holds afterwards."""
    folder = fx.scratch(spark)
    table = StoredTable(spark, f"{folder}/table", COMPLETED_TASKS)
    stream = task_upsert_stream(
        fx.payloads_of(fx.order_stream(spark, sf_dir)),
        table,
        f"{folder}/checkpoint",
        clock=lambda: fx.RUN_TS,
        listing=lambda: fx.projects(spark, sf_dir),
        subtasks=fx.subtasks_of(spark, sf_dir, fx.line_stream(spark, sf_dir)),
    )
    stream.start().awaitTermination()
    return table.read().select(*[f.name for f in schema.COMPLETED_TASKS])


def _late_stream(spark, sf_dir, folder):
    """Two starts of a stream: orders and odd lines have landed for the first, even ones later."""
    table = StoredTable(spark, f"{folder}/table", COMPLETED_TASKS)
    with stored_metrics(spark, f"{folder}/metrics") as figures:
        for late in (False, True):
            landing = fx.land_lines(spark, sf_dir, f"{folder}/landing", late)
            query = task_upsert_stream(
                land.stream_tasks(spark, landing.tasks),
                table,
                f"{folder}/checkpoint",
                clock=lambda: fx.RUN_TS,
                listing=lambda: fx.projects(spark, sf_dir),
                subtasks=land.stream_subtasks(spark, landing.subtasks),
            ).start()
            query.awaitTermination()
            figures.wait_for(str(query.runId), 120)
    return table


@_query
def streamed_late_subtasks(spark, sf_dir):
    """Even lines land after the stream has taken their orders in, and are merged all the same."""
    table = _late_stream(spark, sf_dir, fx.scratch(spark))
    return table.read().select(*[f.name for f in schema.COMPLETED_TASKS])


@_query
def stream_metrics(spark, sf_dir):
    """Rows, errors and refused lines of all micro-batches of the late stream."""
    folder = fx.scratch(spark)
    _late_stream(spark, sf_dir, folder)
    rows = read_metrics(spark, f"{folder}/metrics")
    totals = [F.sum(c).cast("long").alias(c) for c in ("tasks_processed", "errors", "refused")]
    return rows.agg(F.count_distinct("batch_id").alias("batches"), *totals)


@_query
def synced_late_subtasks(spark, sf_dir):
    """Incremental sync: even lines land a day after a full sync has taken their orders in."""
    folder = fx.scratch(spark)
    house = Warehouse(f"{folder}/warehouse")
    for late, day in ((False, "2002-01-01"), (True, "2002-01-02")):
        landing = fx.land_lines(spark, sf_dir, f"{folder}/landing", late, day)
        run_ts = datetime.fromisoformat(f"{day}T20:00:00")
        sync_completed(spark, landing, house, run_ts, SyncOptions(full_sync=not late))
    rows = house.completed(spark).read()
    return rows.select("task_id", "parent_task_id", "project_gid", "completed_at", "is_subtask")


@_query
def synced_entries(spark, sf_dir):
    """Entries of a range of days, from a landing partitioned by day."""
    folder = fx.scratch(spark)
    landing = fx.land_entries(spark, sf_dir, f"{folder}/landing")
    house = Warehouse(f"{folder}/warehouse")
    sync_time_entries(spark, landing, house, fx.RUN_TS, *fx.ENTRY_DAYS)
    return house.entries(spark).read().select(
        F.col("entry_id").alias("gid"), F.col("entered_on").cast("string"), "duration_minutes"
    )


@_query
def quarantined_lines(spark, sf_dir):
    """Landed orders and lines, some cut short and some without an id: what is set aside."""
    folder = fx.scratch(spark)
    landing = fx.land_broken(spark, sf_dir, f"{folder}/landing")
    house = Warehouse(f"{folder}/warehouse")
    sync_completed(spark, landing, house, fx.RUN_TS, SyncOptions(full_sync=True))
    lines = house.quarantine(spark).read()
    return lines.groupBy("source", "reason").agg(F.sum("copies").cast("long").alias("copies"))


@_query
def minutes_backfill(spark, sf_dir):
    return upsert.backfill_minutes(fx.legacy_minutes(spark, sf_dir))


def _stored_snapshots(spark, sf_dir, idempotent):
    """Yesterday's snapshot and a first run of today's stored, then today's again."""
    folder = fx.scratch(spark)
    # At rest, since it is stored three times and its joins need to be made once.
    made = _snapshot(spark, sf_dir)
    made.write.parquet(f"{folder}/made")
    today = spark.read.schema(made.schema).parquet(f"{folder}/made")
    yesterday = today.withColumns(
        {
            "snapshot_date": F.lit(fx.AS_OF - timedelta(days=1)),
            "snapshot_at": ntz_literal(datetime(1998, 6, 16, 7)),
        }
    )
    path = f"{folder}/snapshots"
    for rows in (yesterday, today):
        append_snapshot(rows, path)
    append_snapshot(today, path, idempotent, fx.AS_OF)
    return read_snapshots(spark, path)


@_query
def snapshot_append(spark, sf_dir):
    return _stored_snapshots(spark, sf_dir, idempotent=False)


@_query
def snapshot_replace(spark, sf_dir):
    return _stored_snapshots(spark, sf_dir, idempotent=True)


@_query
def snapshot_of_landings(spark, sf_dir):
    """Landing folders with an older, open version of every order: only the newer counts."""
    folder = fx.scratch(spark)
    landing = fx.landed_twice(spark, sf_dir, f"{folder}/landing")
    house = Warehouse(f"{folder}/warehouse")
    take_snapshot(spark, landing, house, datetime(1998, 6, 17, 7), fx.AS_OF)
    return read_snapshots(spark, house.snapshots)


def _stored_tasks(spark, sf_dir):
    """A warehouse whose task table holds the latest completed version of each task."""
    house = Warehouse(fx.scratch(spark))
    done = fx.raw_tasks(spark, sf_dir).filter(F.col("completed_at").isNotNull())
    house.completed(spark).merge(upsert.latest_in_batch(done), upsert.merge_tasks)
    return house


@_query
def stored_daily_digest(spark, sf_dir):
    return publish.daily_digest(spark, _stored_tasks(spark, sf_dir), fx.AS_OF).summary


@_query
def stored_monthly_latest(spark, sf_dir):
    """The monthly KPI of the newest month, which the table's manifest names."""
    return publish.monthly_digest(spark, _stored_tasks(spark, sf_dir)).kpi


def _published(spark, sf_dir, kind):
    """A report published from the stored totals and read back."""
    house = _stored_tasks(spark, sf_dir)
    publish.publish_reports(spark, house, fx.RUN_TS)
    shown = reports.sheet(reports.report(house.unique(spark), kind), fx.RUN_TS).schema
    return read_report(spark, kind, house.reports, shown)


@_query
def published_report(spark, sf_dir):
    return _published(spark, sf_dir, "project")


@_query
def published_report_assignee(spark, sf_dir):
    return _published(spark, sf_dir, "assignee")


@_query
def published_report_project_assignee(spark, sf_dir):
    return _published(spark, sf_dir, "project_assignee")


@_query
def refreshed_report(spark, sf_dir):
    """Totals made of the earlier tasks, then brought up to date for what a merge touched."""
    house = Warehouse(fx.scratch(spark))
    raw = fx.raw_tasks(spark, sf_dir).filter(F.col("completed_at").isNotNull())
    split = ntz_literal(fx.MERGE_SPLIT)
    for part in (raw.filter(F.col("modified_at") < split), raw.filter(F.col("modified_at") >= split)):
        house.completed(spark).merge(upsert.latest_in_batch(part), upsert.merge_tasks)
        refresh_effort(spark, house)
    return reports.report_from_effort(stored_effort(spark, house), "project_assignee")


@_query
def stored_rewrite(spark, sf_dir):
    """A table without actual minutes, re-clustered as a whole with the minutes filled in."""
    table = StoredTable(spark, fx.scratch(spark), COMPLETED_TASKS)
    rows = upsert.latest_in_batch(fx.raw_tasks(spark, sf_dir))
    table.merge(rows.withColumn("actual_minutes", F.lit(None).cast("double")), upsert.merge_tasks)
    table.rewrite(upsert.backfill_minutes)
    return table.read().select(*[f.name for f in schema.COMPLETED_TASKS])


@_query
def stored_entries(spark, sf_dir):
    """Time entries merged into their table: half of them first, then all."""
    entries = Warehouse(fx.scratch(spark)).entries(spark)
    rows = normalize.time_entry_rows(fx.time_entry_payloads(spark, sf_dir))
    number = F.col("entry_id").cast("bigint")
    for part in (rows.filter(number % 2 == 0), rows):
        entries.merge(
            upsert.stage_entries(part, fx.RUN_TS),
            lambda stored, new, small: upsert.replace_entries(stored, new),
        )
    return entries.read().select(*rows.columns)


@_query
def time_entries_upsert(spark, sf_dir):
    rows = normalize.time_entry_rows(fx.time_entry_payloads(spark, sf_dir))
    number = F.col("entry_id").cast("bigint")
    existing = upsert.stage_entries(rows.filter(number % 2 == 0), datetime(2024, 2, 1))
    changed = rows.filter(number % 3 == 0).withColumns(
        {
            "modified_at": F.timestamp_add("HOUR", F.lit(1), F.col("modified_at")),
            "duration_minutes": F.col("duration_minutes") + 5,
        }
    )
    return upsert.replace_entries(existing, upsert.stage_entries(changed, fx.RUN_TS))


@_query
def dim_projects(spark, sf_dir):
    existing = fx.existing_dim_projects(spark, sf_dir)
    return dims.upsert_projects(existing, _unique(spark, sf_dir), fx.RUN_TS)


@_query
def dim_users(spark, sf_dir):
    existing = fx.existing_dim_users(spark, sf_dir)
    return dims.upsert_users(existing, _unique(spark, sf_dir), fx.RUN_TS)


@_query
def schema_evolve(spark, sf_dir):
    """A table from before the four later columns, with one column it should not have."""
    later = ["project_gid", "assignee_gid", "estimated_minutes", "actual_minutes"]
    old = fx.raw_tasks(spark, sf_dir).drop(*later).withColumn("note", F.lit("x"))
    return schema.conform(old, schema.COMPLETED_TASKS)


@_query
def report_project_sheet(spark, sf_dir):
    return reports.sheet(reports.report(_unique(spark, sf_dir), "project"), fx.RUN_TS)


@_query
def report_assignee_sheet(spark, sf_dir):
    return reports.sheet(reports.report(_unique(spark, sf_dir), "assignee"), fx.RUN_TS)


@_query
def report_project_assignee_sheet(spark, sf_dir):
    rows = reports.report(_unique(spark, sf_dir), "project_assignee")
    return reports.sheet(rows, fx.RUN_TS)


@_query
def run_metrics(spark, sf_dir):
    items = _items(spark, sf_dir, fx.task_payloads(spark, sf_dir))
    batch = upsert.stage_batch(normalize.completed_task_rows(items), fx.RUN_TS)
    return metrics.run_metrics(batch, fx.RUN_TS, fx.RUN_TS + timedelta(minutes=9))


# Views and reports


@_query
def unique_tasks(spark, sf_dir):
    return _unique(spark, sf_dir)


@_query
def unique_tasks_daily(spark, sf_dir):
    return views.unique_tasks_daily(_unique(spark, sf_dir))


@_query
def report_project(spark, sf_dir):
    return reports.report(_unique(spark, sf_dir), "project")


@_query
def report_assignee(spark, sf_dir):
    return reports.report(_unique(spark, sf_dir), "assignee")


@_query
def report_project_assignee(spark, sf_dir):
    return reports.report(_unique(spark, sf_dir), "project_assignee")


# Digests


@_query
def latest_month(spark, sf_dir):
    return monthly.latest_month(_unique(spark, sf_dir))


@_query
def monthly_kpi(spark, sf_dir):
    return monthly.monthly_kpi(_unique(spark, sf_dir), fx.MONTH)


@_query
def monthly_kpi_latest(spark, sf_dir):
    return monthly.monthly_kpi(_unique(spark, sf_dir))


@_query
def monthly_top_projects(spark, sf_dir):
    return monthly.top_projects(_unique(spark, sf_dir), fx.MONTH)


@_query
def monthly_top_assignees(spark, sf_dir):
    return monthly.top_assignees(_unique(spark, sf_dir), fx.MONTH)


@_query
def monthly_top_projects_latest(spark, sf_dir):
    return monthly.top_projects(_unique(spark, sf_dir))


@_query
def monthly_top_assignees_latest(spark, sf_dir):
    return monthly.top_assignees(_unique(spark, sf_dir))


@_query
def daily_kpi(spark, sf_dir):
    return daily.daily_kpi(_unique(spark, sf_dir), fx.AS_OF)


@_query
def business7_baseline(spark, sf_dir):
    return _six_decimals(daily.business_day_baseline(_unique(spark, sf_dir), fx.AS_OF), "avg_hours")


@_query
def daily_deviation(spark, sf_dir):
    return _six_decimals(daily.daily_deviation(_unique(spark, sf_dir), fx.AS_OF), "avg_hours")


@_query
def daily_top_projects(spark, sf_dir):
    return daily.top_projects(_unique(spark, sf_dir), fx.AS_OF)


@_query
def daily_top_assignees(spark, sf_dir):
    return daily.top_assignees(_unique(spark, sf_dir), fx.AS_OF)


@_query
def mtd(spark, sf_dir):
    return daily.month_to_date(_unique(spark, sf_dir), fx.AS_OF)


@_query
def daily_digest(spark, sf_dir):
    return daily.daily_digest(_unique(spark, sf_dir), fx.AS_OF)


@_query
def open_kpi(spark, sf_dir):
    return open_digest.open_kpi(_snapshot(spark, sf_dir), fx.AS_OF)


@_query
def open_top_projects(spark, sf_dir):
    return open_digest.open_top_projects(_snapshot(spark, sf_dir), fx.AS_OF)


@_query
def open_top_assignees(spark, sf_dir):
    return open_digest.open_top_assignees(_snapshot(spark, sf_dir), fx.AS_OF)


@_query
def week_bounds(spark, sf_dir):
    days = fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return weekly.week_bounds(days.distinct())


@_query
def weekly_assignee_plan(spark, sf_dir):
    return weekly.assignee_plan(_snapshot(spark, sf_dir), fx.AS_OF, fx.ALLOWED)


@_query
def weekly_assignee_plan_with_unassigned(spark, sf_dir):
    return weekly.assignee_plan(
        _snapshot(spark, sf_dir), fx.AS_OF, fx.ALLOWED, include_unassigned=True
    )


@_query
def project_overdue(spark, sf_dir):
    return weekly.project_overdue(_snapshot(spark, sf_dir), fx.AS_OF)


@_query
def assignee_overdue(spark, sf_dir):
    return weekly.assignee_overdue(_snapshot(spark, sf_dir), fx.AS_OF, fx.ALLOWED)


@_query
def due_unset(spark, sf_dir):
    return weekly.due_unset(_snapshot(spark, sf_dir), fx.AS_OF, fx.ALLOWED)


# Audits


@_query
def verify_overall(spark, sf_dir):
    return _audited(audit.effort_total(_unique(spark, sf_dir), fx.PROJECT, fx.PERSON))


@_query
def verify_month_completed(spark, sf_dir):
    return _audited(audit.effort_total(_unique(spark, sf_dir), fx.PROJECT, fx.PERSON, fx.MONTH))


@_query
def verify_month_modified(spark, sf_dir):
    return _audited(
        audit.effort_total(
            _unique(spark, sf_dir), fx.PROJECT, fx.PERSON, fx.MONTH, basis="modified"
        )
    )


@_query
def verify_task_ids(spark, sf_dir):
    """Totals of the pair among the urgent orders' first lines and their subtasks."""
    urgent = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    ids = urgent.select(F.concat(F.col("o_orderkey"), F.lit("-1")).alias("task_id"))
    return _audited(audit.effort_total(_unique(spark, sf_dir), fx.PROJECT, fx.PERSON, task_ids=ids))


@_query
def verify_details(spark, sf_dir):
    return audit.effort_details(_unique(spark, sf_dir), fx.PROJECT, fx.PERSON, fx.MONTH)


@_query
def hm_format(spark, sf_dir):
    minutes = F.when(F.col("l_tax") != 0, F.col("l_quantity") * 2.5)
    hours = F.when(F.col("l_discount") != 0, F.floor(F.col("l_extendedprice") / 100) / 60.0)
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        label_from_minutes(minutes).alias("estimated_label"),
        label_from_hours(hours).alias("actual_label"),
    )


@_query
def assignee_quality(spark, sf_dir):
    return audit.assignee_quality(fx.raw_tasks(spark, sf_dir, ["assignee_name"]))


@_query
def assignee_sample(spark, sf_dir):
    return audit.assignee_sample(fx.raw_tasks(spark, sf_dir, ["assignee_name"]))
