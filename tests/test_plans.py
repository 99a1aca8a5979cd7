"""Whole runs from landed payloads to published output."""

import csv
import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from effortlens.operators import normalize, reports, upsert
from effortlens.plans.effort import refresh_effort, stored_effort
from effortlens.plans.publish import (
    daily_digest,
    is_monthly_digest_due,
    monthly_digest,
    open_summary,
    publish_reports,
    run_export,
    seed_dimensions,
    weekly_plan,
)
from effortlens.plans.snapshot import run_snapshot, take_snapshot
from effortlens.plans.sync import SyncOptions, run_nightly, sync_completed, sync_time_entries
from effortlens.plans.warehouse import Landing, Warehouse
from effortlens.session import checkpoint_folder
from effortlens.sources import landing as source
from effortlens.sources.report_sink import published_folder
from effortlens.sources.tables import COMPLETED_TASKS, StoredTable, append_snapshot, read_snapshots
from effortlens.streaming.incremental import task_upsert_stream

RUN = datetime(2024, 6, 1, 3)


def task(gid, done=None, modified="2024-05-20T00:00:00.000Z", **over):
    return {
        "project_gid": "p1",
        "project_name": " Site ",
        "gid": gid,
        "name": gid,
        "completed": done is not None,
        "completed_at": done,
        "created_at": "2024-04-01T00:00:00.000Z",
        "modified_at": modified,
        "due_on": "2024-05-10",
        "assignee": {"gid": "u1", "name": "Ann"},
        "num_subtasks": 0,
        "custom_fields": [{"name": "Estimate", "text_value": "2h"}],
        "actual_time_minutes": 90,
        **over,
    }


PROJECTS = [
    {"gid": "p1", "name": " Site "},
    {"gid": "p2", "name": "Shop", "archived": True},
    {"gid": "p3", "name": "App"},
]
TASKS = [
    task("may", "2024-05-14T15:00:00.000Z"),
    task("april", "2024-04-30T14:00:00.000Z"),
    task("open", subtasks=[task("child")], num_subtasks=1),
    task("archived", "2024-05-14T15:00:00.000Z", project_gid="p2"),
    task("app", "2024-05-15T00:00:00.000Z", project_gid="p3", project_name="App"),
]
for t in TASKS:
    for s in t.get("subtasks", []):
        s.pop("project_gid"), s.pop("project_name")


@pytest.fixture
def folders(land, tmp_path):
    entry = {
        "gid": "e1", "entered_on": "2024-05-31", "duration_minutes": 30,
        "modified_at": "2024-05-31T01:00:00.000Z",
    }
    return (
        Landing(
            land("projects", PROJECTS),
            land("tasks", TASKS),
            land("entries", [entry, {**entry, "gid": "e2", "entered_on": "2024-06-01"}]),
        ),
        Warehouse(str(tmp_path / "warehouse")),
    )


def test_sync_twice_then_report(spark, folders, land, tmp_path):
    landing, house = folders
    first = sync_completed(spark, landing, house, RUN)
    assert (first.tasks_processed, first.errors, first.merge.rows) == (3, 0, 3)
    assert first.cutoff == datetime(2023, 1, 1)
    stored = {r.task_id: r for r in house.completed(spark).read().collect()}
    assert set(stored) == {"may", "april", "app"}
    assert stored["may"].completed_month_jst == "2024-05"
    assert stored["may"].estimated_minutes == 120.0 and stored["may"].inserted_at == RUN

    # The second run starts from the latest modification it holds.
    land("tasks", [task("may", "2024-05-14T15:00:00.000Z", actual_time_minutes=30),
                   task("late", "2024-05-21T00:00:00.000Z")], part=1)
    second = sync_completed(spark, landing, house, datetime(2024, 6, 2))
    assert second.cutoff == datetime(2024, 5, 20)
    assert second.merge.labels == ("2024-05",)
    assert {r.task_id for r in house.completed(spark).read().collect()} == {
        "may", "april", "app", "late",
    }

    full = sync_completed(
        spark, landing, house, datetime(2024, 6, 3), SyncOptions(full_sync=True)
    )
    # Of "may", landed twice, only the newest version counts.
    assert full.cutoff == datetime(1970, 1, 1) and full.tasks_processed == 4
    assert house.completed(spark).read().count() == 4

    assert publish_reports(spark, house, RUN) == {
        "project": True, "assignee": True, "project_assignee": True,
    }
    folder = Path(published_folder(spark, "project", house.reports))
    lines = [
        line for f in sorted(folder.glob("part-*.csv")) for line in list(csv.reader(f.open()))[1:]
    ]
    assert ["2024-05", "App", "1", "1.5", "2.0", "2024-06-01 03:00:00"] in lines
    assert [line[0] for line in lines] == sorted((line[0] for line in lines), reverse=True)

    digest = daily_digest(spark, house, date(2024, 5, 15))
    row = digest.summary.first()
    assert (row.tasks_count, row.mode) == (2, "normal")
    assert [tuple(r) for r in digest.top_assignees.collect()][0][:2] == ("Ann", 2)
    assert digest.top_projects.count() == 2
    kpi = monthly_digest(spark, house).kpi.first()
    assert (kpi.month, kpi.tasks_count) == ("2024-05", 3)
    assert monthly_digest(spark, house, "2024-04").kpi.first().tasks_count == 1
    assert monthly_digest(spark, house, "2024-04").top_projects.count() == 1

    seed_dimensions(spark, house, RUN)
    seed_dimensions(spark, house, datetime(2024, 7, 1))
    projects = {r.project_gid: r for r in house.projects(spark).read().collect()}
    assert {k: v.project_name for k, v in projects.items()} == {"p1": "Site", "p3": "App"}
    assert projects["p1"].created_at == RUN
    assert projects["p1"].updated_at == datetime(2024, 7, 1)
    assert house.users(spark).read().count() == 1


def test_project_filter_and_day_override(spark, folders):
    landing, house = folders
    outcome = sync_completed(
        spark, landing, house, RUN, SyncOptions(project_filter="App", date_jst="2024-05-15")
    )
    assert outcome.cutoff == datetime(2024, 5, 14, 15)
    assert [r.task_id for r in house.completed(spark).read().collect()] == ["app"]
    assert SyncOptions(date_jst="15/05/2024").override() is None


def test_empty_report_keeps_the_published_one(spark, folders):
    landing, house = folders
    assert set(publish_reports(spark, house, RUN).values()) == {False}
    assert not Path(house.reports).exists()


def test_time_entries_of_yesterday(spark, folders):
    landing, house = folders
    result = sync_time_entries(spark, landing, house, RUN)
    assert result.rows == 1
    rows = house.entries(spark).read().collect()
    assert [(r.entry_id, r.duration_hours, r.entered_month) for r in rows] == [
        ("e1", 0.5, "2024-05")
    ]
    sync_time_entries(spark, landing, house, RUN, date(2024, 5, 1), date(2024, 6, 30))
    assert house.entries(spark).read().count() == 2


def test_nightly_run_reports_unreadable_entries_and_goes_on(spark, folders):
    landing, house = folders
    at = datetime(2024, 5, 15, 20)  # the 16th in Tokyo
    run = run_nightly(spark, landing, house, at)
    assert run.tasks.tasks_processed == 3 and run.entries_error is None
    assert run.digest.summary.first().day == "2024-05-15"
    assert run.digest.summary.first().tasks_count == 2
    missing = Landing(landing.projects, landing.tasks, landing.tasks + "-missing")
    again = run_nightly(spark, missing, house, at)
    assert again.entries is None and "PATH_NOT_FOUND" in again.entries_error
    assert again.digest.summary.first().tasks_count == 2


def test_checkpoint_folder_is_the_clusters():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})

    assert checkpoint_folder(Session, "x") == "hdfs://shared/checkpoints/x"
    Session.conf = Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(Session, "x")


def test_snapshot_and_weekly_plan(spark, folders):
    landing, house = folders
    taken = take_snapshot(spark, landing, house, RUN)
    day = taken.day
    assert (day, taken.rejected, taken.malformed) == (date(2024, 6, 1), 0, 0)
    summary = open_summary(spark, house, day)
    assert tuple(summary.kpi.first()) == (2, 2)
    assert [tuple(r) for r in summary.top_projects.collect()] == [(" Site ", 2)]
    assert summary.top_assignees.first().cnt == 2
    plan = weekly_plan(spark, house, day, ["Ann"])
    assert tuple(plan.assignees.first()) == ("Ann", 0, 0.0, 2, 60.0)
    assert tuple(plan.project_overdue.first()) == (" Site ", 2, 60.0)
    assert tuple(plan.assignee_overdue.first()) == ("Ann", 2, 60.0)
    assert plan.due_unset.count() == 0
    take_snapshot(spark, landing, house, RUN, idempotent=True)
    assert open_summary(spark, house, day).kpi.first().open_count == 2


def test_snapshot_counts_the_newest_version_only(spark, land, tmp_path):
    """t1 was open, then done; t2 was landed twice; p3 was archived later."""
    later = "2024-05-25T00:00:00.000Z"
    landing = Landing(land("projects", PROJECTS), land("tasks", [
        task("t1"), task("t2"), task("app", project_gid="p3"), task("keyless", project_name=None),
    ]))
    land("tasks", [task("t1", later, later), task("t2", modified=later)], part=1)
    land("projects", [{"gid": "p3", "name": "App", "archived": True, "modified_at": later}], part=1)
    house = Warehouse(str(tmp_path / "warehouse"))
    run = run_snapshot(spark, landing, house, RUN, ["Ann"])
    rows = read_snapshots(spark, house.snapshots).collect()
    assert sorted(r.task_id for r in rows) == ["keyless", "t2"]
    assert run.plan.assignees.first().prev_overdue_tasks == 2
    # A rerun that finds nothing open leaves nothing of the day.
    land("tasks", [task(t, later, "2024-05-26T00:00:00.000Z") for t in ("t2", "keyless")], part=2)
    take_snapshot(spark, landing, house, RUN, idempotent=True)
    assert read_snapshots(spark, house.snapshots).count() == 0


def test_detached_subtasks_count_once(spark, land, tmp_path):
    child = {k: v for k, v in task("c").items() if not k.startswith("project")}
    landing = Landing(
        land("projects", PROJECTS),
        land("tasks", [task("parent", num_subtasks=1)]),
        subtasks=land("subtasks", [{**child, "parent_gid": "parent"}] * 2),
    )
    house = Warehouse(str(tmp_path / "warehouse"))
    taken = take_snapshot(spark, landing, house, RUN)
    rows = read_snapshots(spark, house.snapshots).collect()
    assert sorted(r.task_id for r in rows) == ["c", "parent"] and taken.malformed == 0


def test_nothing_is_lost_without_a_trace(spark, land, tmp_path):
    folder = land("tasks", [task("good", "2024-05-14T15:00:00.000Z"),
                            task(None, "2024-05-14T15:00:00.000Z")])
    (Path(folder) / "part-009.json").write_text('{"project_gid": "p1", "gid": \n')
    landing, house = Landing(land("projects", PROJECTS), folder), Warehouse(str(tmp_path / "w"))
    outcome = sync_completed(spark, landing, house, RUN)
    assert (outcome.tasks_processed, outcome.errors) == (1, 2)
    assert (outcome.merge.rows, outcome.merge.rejected) == (1, 0)
    taken = take_snapshot(spark, landing, house, RUN)
    assert (taken.malformed, taken.rejected) == (1, 1)


def test_landing_days_before_the_watermark_are_not_read(spark, tmp_path):
    for day, gid in (("2024-05-01", "a"), ("2024-05-20", "b")):
        folder = tmp_path / "tasks" / f"landed_on={day}"
        folder.mkdir(parents=True)
        line = task(gid, f"{day}T00:00:00.000Z", f"{day}T00:00:00.000Z")
        (folder / "part.json").write_text(json.dumps(line))
    rows = source.read_tasks(spark, str(tmp_path / "tasks"), date(2024, 5, 19))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "landed_on" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.gid for r in rows.collect()] == ["b"]


def test_export_sends_the_digest_when_due(spark, folders):
    landing, house = folders
    sync_completed(spark, landing, house, RUN)
    first = run_export(spark, house, datetime(2024, 5, 31, 15))  # June 1st in Tokyo
    assert set(first.published.values()) == {True}
    assert first.digest.kpi.first().month == "2024-05"
    assert run_export(spark, house, datetime(2024, 6, 5)).digest is None
    files = house.unique(spark, date(2024, 5, 1), date(2024, 5, 31)).inputFiles()
    assert set(first.digest.kpi.inputFiles()) == set(files)
    assert sorted(p.name for p in Path(house.reports).iterdir()) == sorted(reports.OUTPUT_NAMES.values())


def test_nightly_recluster_fills_untouched_months(spark, folders):
    landing, house = folders
    sync_completed(spark, landing, house, RUN)
    table = house.completed(spark)
    table.rewrite(lambda rows: rows.withColumn("actual_minutes", F.lit(None).cast("double")))
    run_nightly(spark, landing, house, datetime(2024, 5, 15, 20), recluster=True)
    assert {r.actual_minutes for r in table.read().collect()} == {90.0}


def test_monthly_digest_is_due_on_the_first_local_day():
    assert is_monthly_digest_due(datetime(2024, 5, 31, 15))
    assert not is_monthly_digest_due(datetime(2024, 6, 1, 15))
    assert is_monthly_digest_due(datetime(2024, 6, 2), forced=True)


def test_daily_digest_reads_only_the_months_it_needs(spark, folders):
    landing, house = folders
    sync_completed(spark, landing, house, RUN)
    plan = house.unique(spark, date(2024, 5, 15), date(2024, 5, 15))
    assert all("completed_month_jst=2024-05" in f for f in plan.inputFiles())


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_stream_ends_where_the_batch_does(spark, land, tmp_path, files_per_batch):
    parts = [
        [task("a", "2024-04-02T00:00:00.000Z", "2024-04-02T00:00:00.000Z", name="v1"),
         task("b", "2024-04-03T00:00:00.000Z", "2024-04-03T00:00:00.000Z")],
        [task("a", "2024-05-02T00:00:00.000Z", "2024-05-02T00:00:00.000Z", name="v2"),
         task("open", num_subtasks=1,
              subtasks=[task("c", "2024-05-03T00:00:00.000Z")])],
    ]
    table = StoredTable(spark, str(tmp_path / "streamed"), COMPLETED_TASKS)

    def run():
        stream = source.stream_tasks(spark, folder, files_per_batch)
        query = task_upsert_stream(
            stream, table, str(tmp_path / "checkpoint"), clock=lambda: RUN
        ).start()
        assert query.awaitTermination(300)

    folder = land("tasks", parts[0])
    run()
    land("tasks", parts[1], part=1)
    run()
    run()  # nothing new has landed

    batch = StoredTable(spark, str(tmp_path / "batch"), COMPLETED_TASKS)
    items = normalize.task_items(source.read_tasks(spark, folder))
    rows = upsert.stage_batch(normalize.completed_task_rows(items), RUN)
    batch.merge(
        upsert.latest_in_batch(rows), upsert.merge_tasks, finish=upsert.backfill_minutes
    )
    columns = batch.read().columns
    streamed = sorted(map(tuple, table.read().select(columns).collect()), key=str)
    assert streamed == sorted(map(tuple, batch.read().collect()), key=str)
    assert {r.task_id: r.task_name for r in table.read().collect()} == {
        "a": "v2", "b": "b", "c": "[Subtask] c",
    }
    assert table.last_logged()[0] == 2 if files_per_batch is None else 2


def test_stream_keeps_to_active_projects_like_the_batch(spark, folders, land, tmp_path):
    landing, house = folders
    child = {k: v for k, v in task("c", "2024-05-03T00:00:00.000Z").items() if not k.startswith("project")}
    subtasks = land("subtasks", [{**child, "parent_gid": "app2"}, {**child, "parent_gid": "x"}])
    land("tasks", [task("app2", "2024-05-15T00:00:00.000Z", project_gid="p3", project_name="App",
                        num_subtasks=1)], part=1)
    landing = Landing(landing.projects, landing.tasks, subtasks=subtasks)
    table = StoredTable(spark, str(tmp_path / "streamed"), COMPLETED_TASKS)
    task_upsert_stream(
        source.stream_tasks(spark, landing.tasks),
        table,
        str(tmp_path / "checkpoint"),
        clock=lambda: RUN,
        listing=lambda: source.read_projects(spark, landing.projects),
        subtasks=source.stream_subtasks(spark, subtasks),
    ).start().awaitTermination(300)
    sync_completed(spark, landing, house, RUN)
    columns = table.read().columns
    streamed = sorted(map(tuple, table.read().collect()), key=str)
    batch = house.completed(spark).read().select(columns)
    assert streamed == sorted(map(tuple, batch.collect()), key=str)
    assert {r[columns.index("task_id")] for r in streamed} == {"may", "april", "app", "app2", "c"}


def test_totals_of_a_large_month_are_written_by_many_tasks(spark, tmp_path, completed_rows):
    """The totals grow with the people; no task may have to hold and write all of them."""
    house, number = Warehouse(str(tmp_path / "house")), F.col("id")
    one = completed_rows({"task_id": "x", "completed_at": datetime(2024, 5, 2), "actual_minutes": 6.0})
    one = one.drop("task_id", "assignee_name")
    rows = one.crossJoin(spark.range(4000)).withColumns(
        {"task_id": number.cast("string"), "assignee_name": F.concat(F.lit("Person "), number)}
    )
    house.completed(spark).merge(rows.drop("id"), upsert.merge_tasks)
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    for name, size in small.items():
        spark.conf.set(name, size)
    try:
        refresh_effort(spark, house)
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(list((tmp_path / "house/monthly_effort/month=2024-05").glob("part-*"))) > 1
    held = stored_effort(spark, house)
    assert held.count() == 4000 and held.agg(F.sum("actual")).first()[0] == 24000


def test_a_snapshot_that_is_stored_again_is_not_joined_again(spark, sf_dir, monkeypatch):
    from effortlens.checks import queries

    read = []

    def noting(rows, path, *more):
        read.extend(rows.inputFiles())
        return append_snapshot(rows, path, *more)

    monkeypatch.setattr(queries, "append_snapshot", noting)
    queries.all_queries()["snapshot_append"](spark, sf_dir)
    assert read and not any("lineitem" in f or "part.parquet" in f for f in read)
