"""Stored tables: what a reader sees after merges, moves, failures and reruns."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.operators import reports, upsert
from effortlens.sources import folders, report_sink, tables

JAN, FEB, MAR = datetime(2024, 1, 10), datetime(2024, 2, 10), datetime(2024, 3, 10)


@pytest.fixture
def table(spark, tmp_path):
    return tables.StoredTable(spark, str(tmp_path / "tasks"), tables.COMPLETED_TASKS, 2)


def merge(table, batch, **kw):
    return table.merge(batch, upsert.merge_tasks, **kw)


def months(table):
    return {r.task_id: r.completed_month_jst for r in table.read().collect()}


def test_empty_table_reads_as_empty(table):
    assert table.read().count() == 0
    assert table.labels() == [] and table.last_logged() == (0, None, None)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_row_that_changes_month_is_there_once(spark, table, completed_rows, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        merge(
            table,
            completed_rows(
                {"task_id": "a", "completed_at": JAN},
                {"task_id": "b", "completed_at": JAN},
                {"task_id": "c", "completed_at": FEB},
                {"task_id": "m", "completed_at": MAR},
            ),
        )
        result = merge(table, completed_rows({"task_id": "a", "completed_at": FEB}))
        assert result.labels == ("2024-01", "2024-02")
        merge(table, completed_rows({"task_id": "c"}))
        expected = {"a": "2024-02", "b": "2024-01", "c": "none", "m": "2024-03"}
        assert months(table) == expected
        merge(table, completed_rows({"task_id": "b", "completed_at": MAR}))
        assert months(table) == {**expected, "b": "2024-03"}
        assert table.read(["2024-01"]).count() == 0
        assert table.labels() == ["2024-02", "2024-03", "none"]
        assert table.last_logged()[0] == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_changed_row_rewrites_one_bucket(spark, tmp_path, completed_rows):
    table = tables.StoredTable(spark, str(tmp_path / "t"), tables.COMPLETED_TASKS, 4)
    rows = [{"task_id": f"t{i}", "completed_at": (JAN, FEB)[i % 2]} for i in range(60)]
    first = merge(table, completed_rows(*rows))
    assert len(first.rewritten) == 8
    before = set(table.read().inputFiles())
    result = merge(table, completed_rows({**rows[7], "task_name": "new"}))
    assert len(result.rewritten) == 1 and result.labels == ("2024-02",)
    kept = before & set(table.read().inputFiles())
    assert len(before - kept) == 1
    assert table.read().count() == 60


def test_failed_merge_changes_nothing(table, completed_rows):
    merge(table, completed_rows({"task_id": "a", "task_name": "v1", "completed_at": JAN}))

    def broken(rows):
        return rows.withColumn("task_name", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        merge(
            table,
            completed_rows({"task_id": "a", "task_name": "v2", "completed_at": JAN}),
            finish=broken,
        )
    assert table.last_logged()[0] == 1
    assert table.read().first().task_name == "v1"
    merge(table, completed_rows({"task_id": "a", "task_name": "v3", "completed_at": JAN}))
    assert [r.task_name for r in table.read().collect()] == ["v3"]


@pytest.mark.parametrize("steps", range(12))
def test_a_merge_killed_at_any_step_is_finished_by_the_next_call(
    spark, tmp_path, completed_rows, monkeypatch, steps
):
    """The process dies before the n-th change of the file system of a second merge."""
    table = tables.StoredTable(spark, str(tmp_path / "t"), tables.COMPLETED_TASKS, 2)
    merge(table, completed_rows(
        {"task_id": "a", "task_name": "v1", "project_gid": "p", "completed_at": JAN},
        {"task_id": "b", "completed_at": JAN},
        {"task_id": "c", "completed_at": FEB},
        {"task_id": "alone", "completed_at": MAR},
    ))
    batch = completed_rows(
        {"task_id": "a", "task_name": "v2", "completed_at": FEB},
        {"task_id": "alone", "completed_at": FEB},
        {"task_id": "new", "completed_at": JAN},
    )
    done = 0
    real = {name: getattr(folders, name) for name in ("put", "delete", "write_text")}

    def until(name):
        def run(*args):
            nonlocal done
            done += 1
            if done > steps:
                raise KeyboardInterrupt("killed")
            return real[name](*args)

        return run

    for name in real:
        monkeypatch.setattr(folders, name, until(name))
    finished = True
    try:
        merge(table, batch)
    except KeyboardInterrupt:
        finished = False
    for name, function in real.items():
        monkeypatch.setattr(folders, name, function)
    merge(table, batch)
    rows = {r.task_id: r for r in table.read().collect()}
    assert table.read().count() == 5 and not (tmp_path / "t" / "_pending").exists()
    assert {k: r.completed_month_jst for k, r in rows.items()} == {
        "a": "2024-02", "b": "2024-01", "c": "2024-02", "alone": "2024-02", "new": "2024-01",
    }
    # The stored project outlives the crash: the batch has none.
    assert (rows["a"].task_name, rows["a"].project_gid) == ("v2", "p")
    assert "2024-03" not in table.labels() and (finished or steps < 12)


def test_rows_without_key_are_rejected_and_an_empty_batch_changes_nothing(spark, table):
    rows = spark.createDataFrame(
        [(None, JAN)], "task_id string, completed_at timestamp_ntz"
    ).withColumn("inserted_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    result = merge(table, schema.conform(rows, schema.COMPLETED_TASKS))
    assert (result.rows, result.rejected, table.last_logged()[0]) == (0, 1, 0)


def test_a_batch_merged_again_changes_nothing(table, completed_rows):
    first = completed_rows({"task_id": "a", "task_name": "v1", "completed_at": JAN})
    merge(table, first)
    before = [tuple(r) for r in table.read().collect()]
    assert merge(table, first).rows == 1
    assert [tuple(r) for r in table.read().collect()] == before


def test_log_says_when_and_what_was_merged(table, completed_rows):
    merge(table, completed_rows({"task_id": "a", "completed_at": JAN, "modified_at": FEB}), stamp=MAR)
    merge(table, completed_rows({"task_id": "a", "completed_at": FEB, "modified_at": JAN}))
    rows = sorted(table.log().collect(), key=lambda r: r.number)
    assert [(r.rows, r.rejected, r.labels) for r in rows] == [
        (1, 0, ["2024-01"]), (1, 0, ["2024-01", "2024-02"]),
    ]
    assert table.last_logged() == (2, MAR, "2024-02-10T00:00:00.000Z")


def test_replaced_content_leaves_nothing_behind(spark, table, completed_rows):
    merge(table, completed_rows({"task_id": "a", "completed_at": JAN}, {"task_id": "b"}))
    assert table.replace(table.read().filter("task_id = 'b'").select(*completed_rows().columns)) == 0
    assert months(table) == {"b": "none"}
    assert table.replace(completed_rows()) == 0 and table.read().count() == 0


def test_minutes_are_filled_while_merging(table, completed_rows):
    merge(
        table,
        completed_rows({"task_id": "a", "completed_at": JAN, "actual_time": 1.5}),
        finish=upsert.backfill_minutes,
    )
    assert table.read().first().actual_minutes == 90.0


def test_large_month_is_split_over_files(spark, table):
    """One month with nearly all rows is written by several tasks."""
    rows = spark.range(0, 200_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("task_id"),
        F.when(F.col("id") % 100 == 0, F.lit("2024-02-10")).otherwise(F.lit("2024-01-10"))
        .cast("timestamp_ntz").alias("completed_at"),
        F.lit("2024-03-01").cast("timestamp_ntz").alias("inserted_at"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        merge(table, schema.conform(rows, schema.COMPLETED_TASKS))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(table.read(["2024-01"]).inputFiles()) > table.buckets
    assert len(table.read(["2024-02"]).inputFiles()) == table.buckets
    assert table.read().count() == 200_000


def test_rewrite_keeps_rows_and_orders_files(spark, table, completed_rows):
    merge(
        table,
        completed_rows(
            *[
                {"task_id": f"t{i}", "completed_at": JAN, "project_gid": f"p{i % 3}",
                 "actual_time": 1.0}
                for i in range(30)
            ]
        ),
    )
    table.rewrite(upsert.backfill_minutes)
    rows = table.read().collect()
    assert len(rows) == 30 and {r.actual_minutes for r in rows} == {60.0}
    for name in table.read().inputFiles():
        gids = [r.project_gid for r in spark.read.parquet(name).select("project_gid").collect()]
        assert gids == sorted(gids)


def snapshot_rows(spark, *rows):
    made = [(date.fromisoformat(d), datetime(2024, 1, 1), t) for d, t in rows]
    df = spark.createDataFrame(
        made, "snapshot_date date, snapshot_at timestamp_ntz, task_id string"
    )
    return schema.conform(df, schema.OPEN_TASKS_SNAPSHOT)


def test_snapshot_rerun_appends_or_replaces(spark, tmp_path):
    path = str(tmp_path / "snap")
    tables.append_snapshot(snapshot_rows(spark, ("2024-01-01", "a")), path)
    tables.append_snapshot(snapshot_rows(spark, ("2024-01-02", "a")), path)
    tables.append_snapshot(snapshot_rows(spark, ("2024-01-02", "b")), path)
    stored = tables.read_snapshots(spark, path)
    assert stored.groupBy("snapshot_date").count().count() == 2 and stored.count() == 3
    again = snapshot_rows(spark, ("2024-01-02", "c"))
    tables.append_snapshot(again, path, idempotent=True)
    left = {(str(r.snapshot_date), r.task_id) for r in tables.read_snapshots(spark, path).collect()}
    assert left == {("2024-01-01", "a"), ("2024-01-02", "c")}


def test_snapshot_from_before_the_effort_columns(spark, tmp_path):
    path = str(tmp_path / "snap")
    old = snapshot_rows(spark, ("2024-01-01", "a")).drop("estimated_minutes", "actual_minutes")
    old.write.partitionBy("snapshot_date").parquet(path)
    row = tables.read_snapshots(spark, path).first()
    assert row.task_id == "a" and row.estimated_minutes is None


def test_snapshot_read_is_partition_pruned(spark, tmp_path):
    from effortlens.operators.open_tasks import open_kpi

    path = str(tmp_path / "snap")
    tables.append_snapshot(
        snapshot_rows(spark, ("2024-01-01", "a"), ("2024-01-02", "b")), path
    )
    kpi = open_kpi(tables.read_snapshots(spark, path), date(2024, 1, 2))
    plan = kpi._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert kpi.first().open_count == 1


def test_nothing_is_left_behind(tmp_path, table, completed_rows):
    for n in range(4):
        merge(table, completed_rows({"task_id": f"t{n}", "completed_at": JAN}))
    assert [p.name for p in tmp_path.iterdir()] == ["tasks"]
    names = {p.name for p in (tmp_path / "tasks").iterdir()}
    assert names == {"completed_month_jst=2024-01", "_log", "_staging"}
    assert not list((tmp_path / "tasks" / "_staging").glob("*"))


def effort(spark, *rows):
    return spark.createDataFrame(
        [("2024-01", name, n, 1.5, 2.0) for name, n in rows],
        "month string, project_name string, tasks_count long, total_actual_hours double, "
        "total_estimated_hours double",
    )


def published(spark, folder, rows):
    shown = reports.sheet(rows, JAN).schema
    return [r[1] for r in report_sink.read_report(spark, "project", folder, shown).collect()]


def test_readers_take_the_newest_complete_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "reports")
    one, two = effort(spark, ("one", 1)), effort(spark, ("two", 2))
    assert published(spark, folder, one) == []
    assert report_sink.publish_report(one, "project", folder, JAN)
    broken = two.withColumn(
        "project_name", F.when(F.rand() < 2, F.raise_error(F.lit("lost")).cast("string"))
    )
    with pytest.raises(Exception, match="lost"):
        report_sink.publish_report(broken, "project", folder, JAN)
    assert published(spark, folder, one) == ["one"]

    # A job that dies after its files, before the mark: readers stay with the old version.
    assert report_sink.publish_report(two, "project", folder, JAN)
    current = Path(report_sink.published_folder(spark, "project", folder))
    (current / "_SUCCESS").unlink()
    assert published(spark, folder, one) == ["one"]
    assert report_sink.publish_report(two, "project", folder, JAN)
    assert published(spark, folder, one) == ["two"]
    # One that dies before old versions are removed leaves the new one current.
    monkeypatch.setattr(folders, "delete", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        report_sink.publish_report(effort(spark, ("three", 3)), "project", folder, JAN, keep=1)
    monkeypatch.undo()
    assert published(spark, folder, one) == ["three"]
    assert report_sink.publish_report(one, "project", folder, JAN)
    kept = list((Path(folder) / reports.OUTPUT_NAMES["project"]).iterdir())
    assert len(kept) == 2


def test_small_files_are_read_as_written(spark, tmp_path):
    file = str(tmp_path / "a" / "note.json")
    assert folders.read_text(spark, file) is None
    for text in ("", json.dumps({"k": "é"})):
        folders.write_text(spark, file, text)
        assert folders.read_text(spark, file) == text


def test_a_large_batch_leaves_unnamed_rows_out_of_its_join(spark, table, completed_rows):
    """Only stored rows whose key the batch names are combined; the result is as with all."""
    one = completed_rows({"task_id": "x", "completed_at": JAN, "project_gid": "p"}).drop("task_id")

    def tasks(first, last):
        ids = spark.range(first, last).select(F.sha2(F.col("id").cast("string"), 256).alias("task_id"))
        return schema.conform(ids.crossJoin(one), schema.COMPLETED_TASKS)

    stored = tasks(0, 4000)
    batch = tasks(3990, 8000).withColumns({"project_gid": F.lit(None).cast("string"), "task_name": F.lit("new")})
    merge(table, stored)
    met = []

    def combine(target, new, small):
        met.append(target.count())
        return upsert.merge_tasks(target, new, small)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        assert table.merge(batch, combine).rows == 4010
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(met) == 10
    names = stored.columns
    expected = upsert.merge_tasks(stored, batch).select(names).collect()
    assert sorted(map(tuple, table.read().select(names).collect()), key=str) == sorted(map(tuple, expected), key=str)
    assert table.read().filter("task_name = 'new' and project_gid = 'p'").count() == 10
