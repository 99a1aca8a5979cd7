"""Physical plans: what is pushed, pruned, broadcast and reduced before a shuffle."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from effortlens.checks.queries import all_queries
from effortlens import schema
from effortlens.checks import fixtures as fx
from effortlens.operators import audit, daily, open_tasks, reports, scans, upsert, views, weekly
from effortlens.sources import landing as land
from effortlens.sources import tables


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_version_ranking_reduces_before_its_shuffle(spark, sf_dir):
    plan = plan_of(views.unique_tasks(fx.completed_tasks(spark, sf_dir)))
    partial, final = plan.index("row_number(), 1, Partial"), plan.index("row_number(), 1, Final")
    assert final < plan.index("Exchange hashpartitioning(task_id") < partial


def test_reports_shuffle_only_for_versions_totals_and_order(spark, sf_dir):
    plan = plan_of(reports.report(views.unique_tasks(fx.completed_tasks(spark, sf_dir)), "project"))
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)
    assert sorted(shuffles) == ["hashpartitioning", "hashpartitioning", "rangepartitioning"]
    assert "o_orderdate" not in plan


@pytest.mark.parametrize("name", ["monthly_top_projects", "open_top_assignees", "due_unset"])
def test_top_lists_never_sort_everything(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_no_query_makes_pairs_or_runs_python(spark, sf_dir):
    for name, query in all_queries().items():
        plan = plan_of(query(spark, sf_dir))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert operator not in plan, name


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    table = tables.StoredTable(
        spark, str(tmp_path_factory.mktemp("stored")), tables.COMPLETED_TASKS
    )
    batch = schema.conform(fx.raw_tasks(spark, sf_dir), schema.COMPLETED_TASKS)
    table.merge(upsert.latest_in_batch(batch), upsert.merge_tasks)
    return table


def test_stored_day_scan_is_pruned_pushed_and_unshuffled(spark, stored):
    day = date(1998, 6, 17)
    unique = views.unique_tasks(stored.read(["1998-06"]), one_row_per_task=True)
    kpi = daily.on_days(unique, day, day).select("actual_minutes")
    plan = plan_of(kpi)
    assert "Exchange" not in plan and "Window" not in plan
    assert "GreaterThanOrEqual(completed_at,1998-06-16T15:00)" in plan
    assert "LessThan(completed_at,1998-06-17T15:00)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in read.split(",")) == {"completed_at", "actual_minutes"}
    assert all("1998-06" in f for f in unique.inputFiles())


def test_watermark_and_latest_month_come_without_a_scan(spark, stored):
    newest = stored.read().agg(F.max("modified_at")).first()[0]
    assert stored.high_water() == newest.strftime("%Y-%m-%dT%H:%M:%S.") + "000Z"
    months = [r[0] for r in stored.read().select("completed_month_jst").distinct().collect()]
    assert stored.labels() == sorted(months)


def test_partition_column_prunes_too(spark, stored):
    plan = plan_of(stored.read().filter(F.col("completed_month_jst") == "1998-06"))
    assert re.search(r"PartitionFilters: \[isnotnull\(completed_month_jst", plan)


def test_stored_table_gives_the_same_reports(spark, sf_dir, stored):
    """All tasks whose latest version is completed, through either form of the view."""
    latest = upsert.latest_in_batch(fx.raw_tasks(spark, sf_dir))
    for kind in reports.REPORT_KEYS:
        ranked = reports.report(views.unique_tasks(latest), kind).collect()
        plain = views.unique_tasks(stored.read(), one_row_per_task=True)
        assert reports.report(plain, kind).collect() == ranked


def test_small_batch_leaves_the_target_unshuffled(spark, stored, completed_rows, tmp_path):
    folder = str(tmp_path / "batch")
    completed_rows({"task_id": "1-1"}, {"task_id": "new"}).write.parquet(folder)
    batch = spark.read.parquet(folder)
    target = stored.read().drop("completed_month_jst")
    plan = plan_of(upsert.merge_tasks(target, batch, small_batch=True))

    assert "BroadcastHashJoin [task_id" in plan and "LeftOuter, BuildRight" in plan
    assert "FullOuter" not in plan
    assert "FullOuter" in plan_of(upsert.merge_tasks(target, batch))


def test_allow_list_is_a_filter_and_overdue_is_one_partition(spark, sf_dir, tmp_path):
    path = str(tmp_path / "snap")
    query = registry.queries()["open_tasks_overdue"]
    tables.append_snapshot(query(spark, sf_dir), path)
    snaps = tables.read_snapshots(spark, path)
    plan = plan_of(weekly.assignee_plan(snaps, fx.AS_OF, fx.ALLOWED))
    assert "Join" not in plan and "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan_of(
        open_tasks.open_top_projects(snaps, fx.AS_OF)
    )


def test_long_id_list_is_told_by_a_map_before_any_shuffle(spark, completed_rows):
    rows = spark.range(0, 20_000).select(
        F.concat(F.lit("t"), "id").alias("task_id"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("t"), (F.col("id") + 1).cast("string"))).alias("parent_task_id"),
    )
    tasks = schema.conform(rows, schema.COMPLETED_TASKS)
    ids = spark.range(0, 20_000, 500).select(F.concat(F.lit("t"), F.col("id") + 1).alias("id"))
    few = audit.maybe_listed(tasks, ids)
    exact = audit.of_task_ids(tasks, ids)
    # Listed ids t1, t501, ... and their children t0, t500, ...
    assert exact.count() == 80 and 80 <= few.count() <= 90
    plan = plan_of(few)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert audit.id_map(ids).count() <= audit.MAP_BITS // 32768
    assert exact.filter(F.col("task_id").isin("t500", "t501")).count() == 2


def test_entries_are_read_by_the_folders_of_their_days(spark, sf_dir, tmp_path):
    landing = fx.land_entries(spark, sf_dir, str(tmp_path))
    entries = scans.entries_between(
        land.read_time_entries(spark, landing.time_entries), *fx.ENTRY_DAYS,
        keep=F.col(land.MALFORMED).isNotNull(),
    )
    filters = plan_of(entries).split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "entered_on" in filters and "1998" not in filters
    everything = spark.read.schema(schema.TIME_ENTRY).json(landing.time_entries)
    assert {r.entered_on for r in everything.select("entered_on").distinct().collect()} >= {"soon"}
    payloads = fx.time_entry_payloads(spark, sf_dir)
    want = scans.entries_between(payloads, *fx.ENTRY_DAYS).select("gid", "entered_on")
    assert sorted(entries.select("gid", "entered_on").collect()) == sorted(want.collect())


def test_totals_agree_across_reports(spark, sf_dir):
    """Projects add up to the month, and pairs add up to assignees."""
    unique = views.unique_tasks(fx.completed_tasks(spark, sf_dir)).cache()
    try:
        by_project = reports.report(unique, "project").groupBy("month").agg(
            F.sum("tasks_count").alias("n")
        )
        per_month = reports.effort_by(unique, ["month"])
        wrong = by_project.join(per_month, "month", "full").filter(~F.col("n").eqNullSafe(F.col("tasks")))
        assert wrong.count() == 0
        pairs = reports.report(unique, "project_assignee").groupBy("month", "assignee_name").agg(
            F.sum("tasks_count").alias("n")
        )
        people = reports.report(unique, "assignee").select("month", "assignee_name", "tasks_count")
        wrong = pairs.join(people, ["month", "assignee_name"], "full").filter(
            ~F.col("n").eqNullSafe(F.col("tasks_count"))
        )
        assert wrong.count() == 0
    finally:
        unique.unpersist()
