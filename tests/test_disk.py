"""What merges, folds, streams and rewrites shuffle, and that it does not pile up on disk."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.operators import scans, upsert
from effortlens.session import freed_shuffles
from effortlens.sources import tables
from effortlens.streaming.incremental import bare_facts, streamed_items

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def many_tasks(spark, versions=2):
    instant = F.timestamp_add("DAY", F.col("id") % 60, F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = spark.range(0, 4000, numPartitions=4).select(
        (F.col("id") / versions).cast("int").cast("string").alias("task_id"),
        instant.alias("completed_at"),
        instant.alias("modified_at"),
        F.lit("2024-05-01").cast("timestamp_ntz").alias("inserted_at"),
    )
    return schema.conform(rows, schema.COMPLETED_TASKS)


def test_a_merge_leaves_no_shuffle_files(spark, tmp_path):
    table = tables.StoredTable(spark, str(tmp_path / "t"), tables.COMPLETED_TASKS)
    before = shuffle_files(spark)
    for _ in range(2):
        table.merge(upsert.latest_in_batch(many_tasks(spark)), upsert.merge_tasks)
    assert table.read().count() == 2000
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    # What the merge asks for besides (touched places, folders' sizes) is not rows.
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    sizes = [f.length() for f in (folder.getFile(n) for n in left)]
    assert sum(sizes) < 20_000


def test_the_setting_is_put_back_after_nested_writes(spark):
    assert spark.conf.get(CLEANUP, None) is None
    with freed_shuffles(spark):
        with pytest.raises(OSError), freed_shuffles(spark):
            raise OSError("full")
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) is None


VERSIONS = "project_gid string, gid string, name string, done boolean, modified_at string, minutes double"


@pytest.mark.parametrize("few", [False, True])
def test_landed_versions_newer_than_the_held_ones(spark, few):
    """Against plain Python, ties, nulls, repeated and older versions included."""
    key = ("project_gid", "gid")
    days = [None, "no date", *[f"2024-01-0{d}T00:00:00Z" for d in range(1, 6)]]
    landed = [
        ("p", str(g % 40), (None, "", "a", "b")[g % 4], (None, True, False)[g % 3], days[g * 7 % 11 % 7], float(g))
        for g in range(400)
    ]
    held = [("p", str(g), ("a", None)[g % 2], True, days[g % 7], -1.0) for g in range(0, 60, 2)]
    held += [landed[1], landed[3]]  # landed again, as they are held

    def rank(row):
        def null_first(v):
            return (v is not None, v if v is not None else "")

        instant = row[4] if row[4] and row[4].startswith("2024") else None
        done = None if row[3] is None else str(row[3]).lower()
        return [null_first(v) for v in (instant, row[2], done, row[4])]

    want = {}
    for row in landed:
        if row[:2] not in want or rank(row) > rank(want[row[:2]]):
            want[row[:2]] = row
    known = {row[:2]: row for row in held}
    want = {k: rank(r) for k, r in want.items() if k not in known or rank(r) > rank(known[k])}
    frames = [spark.createDataFrame(rows, VERSIONS) for rows in (landed, list(known.values()))]
    newer = scans.newer_payloads(*frames, *key, few=few)
    got = [tuple(r) for r in newer.collect()]
    assert newer.columns == frames[0].columns and 0 < len(want) < 40
    assert {r[:2]: rank(r) for r in got} == want and len(got) == len(want)
    assert all(r[5] >= 0 for r in got)


def test_landed_rows_are_shuffled_once_to_find_the_newer_ones(spark, tmp_path):
    frames = []
    for name in ("landed", "known"):
        rows = spark.range(0, 2000, numPartitions=2).select(
            F.lit("p").alias("project_gid"), F.col("id").cast("string").alias("gid"),
            F.lit("name").alias("name"), F.lit("2024-01-01T00:00:00Z").alias("modified_at"),
        )
        rows.write.parquet(str(tmp_path / name))
        frames.append(spark.read.schema(rows.schema).parquet(str(tmp_path / name)))
    newer = scans.newer_payloads(*frames, "project_gid", "gid")
    assert plan_of(newer).count("Exchange") == 1 and newer.count() == 0


def test_a_rewrite_shuffles_only_partitions_of_many_small_files(spark, tmp_path):
    table = tables.StoredTable(spark, str(tmp_path / "t"), tables.COMPLETED_TASKS, 2)
    table.merge(many_tasks(spark, 1).withColumn("actual_time", F.lit(2.0)), upsert.merge_tasks)
    assert "Exchange" not in plan_of(table._rewritten(upsert.backfill_minutes, []))
    more = table.read(["2024-01"]).withColumn("task_id", F.concat(F.lit("x"), "task_id"))
    for part in (0, 1):  # two more files in each place of one month
        some = table._placed(more.filter(F.xxhash64("task_id") % 2 == part).coalesce(1))
        some.write.mode("append").partitionBy(*table.layout.parts).parquet(table.path)
    before = sorted(r.task_id for r in table.read().select("task_id").collect())
    assert {n > 1 for p, (n, _) in table._files().items() if "2024-01" in p} == {True}
    table.rewrite(upsert.backfill_minutes)
    assert set(n for n, _ in table._files().values()) == {1}
    assert sorted(r.task_id for r in table.read().select("task_id").collect()) == before
    assert {r[0] for r in table.read().select("actual_minutes").distinct().collect()} == {120.0}
    for name in table.read().inputFiles():
        assert name.split("/")[-3].startswith("completed_month_jst=")


def payloads(spark, kind, *rows):
    made = [tuple(r.get(f.name) for f in kind) for r in rows]
    return spark.createDataFrame(made, kind)


def test_open_versions_carry_no_more_than_what_tells_them(spark):
    body = {"parent_gid": "P", "name": "n", "created_at": "2024-01-01T00:00:00Z", "due_on": "2024-01-09",
            "assignee": ("u", "Ann"), "actual_time_minutes": 5.0, "modified_at": "2024-01-02T00:00:00Z"}
    rows = payloads(
        spark,
        schema.DETACHED_SUBTASK,
        {**body, "gid": "done", "completed": True, "completed_at": "2024-01-02T00:00:00Z"},
        {**body, "gid": "open", "completed": False},
        {**body, "gid": "undated", "completed": True, "completed_at": "soon"},
        {**body, "gid": "unknown"},
    )
    told = {"parent_gid", "gid", "completed", "completed_at", "modified_at"}
    for include, full in ((False, {"done"}), (True, {"done", "open", "undated", "unknown"})):
        got = {r.gid: r.asDict() for r in bare_facts(rows, True, include).collect()}
        assert set(got) == {"done", "open", "undated", "unknown"}
        for gid, row in got.items():
            assert row["modified_at"] == datetime(2024, 1, 2) and row["parent_gid"] == "P"
            rest = [row[c] for c in row if c not in told]
            assert all(v is None for v in rest) == (gid not in full)
        assert got["done"]["actual_minutes"] == 5.0 and got["done"]["assignee_name"] == "Ann"
    parents = payloads(
        spark, schema.TASK,
        {"project_gid": "p", "project_name": "Site", "gid": "P", "completed": False, "num_subtasks": 1,
         "modified_at": "2024-01-03T00:00:00Z"},
    )
    items = streamed_items(bare_facts(parents, False, False), bare_facts(rows, True, False), None, None)
    found = {r.gid: r for r in items.collect()}
    # A parent that is open still names its project to its subtasks.
    assert found["done"].project_name == "Site" and found["done"].parent_task_id == "P"
    assert len(found) == 5 and found["P"].is_subtask is False
