"""The test tables, read as work-log inputs, hold the expected numbers of rows."""

from pyspark.sql import functions as F

from effortlens.checks import fixtures as fx
from effortlens.functions.timeutil import ntz_literal
from effortlens.operators import daily, upsert, views


def test_task_counts(spark, sf_dir):
    raw = fx.raw_tasks(spark, sf_dir, ["task_id", "completed_at"])
    counts = raw.agg(F.count("*"), F.countDistinct("task_id"), F.count("completed_at")).first()
    assert tuple(counts) == (6000, 4599, 3010)
    unique = views.unique_tasks(fx.completed_tasks(spark, sf_dir))
    assert unique.count() == 2624
    assert daily.daily_kpi(unique, fx.AS_OF).first().tasks_count == 2


def test_merge_counts(spark, sf_dir):
    raw = fx.raw_tasks(spark, sf_dir)
    split = ntz_literal(fx.MERGE_SPLIT)
    target = upsert.latest_in_batch(raw.filter(F.col("modified_at") < split))
    batch = upsert.latest_in_batch(raw.filter(F.col("modified_at") >= split))
    both = target.join(batch.select("task_id"), "task_id", "left_semi")
    assert (target.count(), batch.count(), both.count()) == (2997, 2251, 649)


def test_unneeded_tables_are_not_read(spark, sf_dir):
    files = fx.raw_tasks(spark, sf_dir, ["task_id", "modified_at"]).inputFiles()
    assert [f.rsplit("/", 1)[1] for f in files] == ["lineitem.parquet"]
