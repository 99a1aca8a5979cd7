"""One key with a large share of all rows: results stay whole and plans stay split."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.operators import audit, normalize, reports, upsert, views

N = 60_000
HOT_SHARE = 3  # one row in three


@pytest.fixture(scope="module")
def versions(spark, tmp_path_factory):
    """Many versions of which a third belong to one task, project and person."""
    hot = F.col("id") % HOT_SHARE == 0
    key = F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string"))
    instant = F.timestamp_add(
        "SECOND", F.col("id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    )
    rows = spark.range(0, N, numPartitions=6).select(
        key.alias("task_id"),
        F.when(hot, "P hot").otherwise("P cold").alias("project_name"),
        F.when(hot, "p1").otherwise("p2").alias("project_gid"),
        F.when(hot, "Ann").otherwise("Bob").alias("assignee_name"),
        instant.alias("completed_at"),
        instant.alias("modified_at"),
        instant.alias("inserted_at"),
        F.lit(60.0).alias("actual_minutes"),
        F.when(~hot, F.lit("hot")).alias("parent_task_id"),
    )
    path = str(tmp_path_factory.mktemp("skew") / "versions")
    schema.conform(rows, schema.COMPLETED_TASKS).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_task_keeps_its_latest_version(versions):
    unique = views.unique_tasks(versions)
    assert unique.count() == N - N // HOT_SHARE + 1
    hot = unique.filter("task_id = 'hot'").collect()
    assert [r.completed_at for r in hot] == [datetime(2024, 1, 1, 16, 39, 57)]


def test_hot_task_is_reduced_before_the_shuffle(spark, versions):
    """The ranking's shuffle carries one hot row per map task, not a third of all rows."""
    ranked = views.unique_tasks(versions.filter("task_id = 'hot'"))
    assert len(ranked.collect()) == 1
    written = 0
    node = ranked._jdf.queryExecution().executedPlan()
    pending = [node.executedPlan() if hasattr(node, "executedPlan") else node]
    while pending:
        current = pending.pop()
        if "Exchange" in current.nodeName():
            written += current.metrics().apply("shuffleRecordsWritten").value()
        if "QueryStage" in current.nodeName():
            pending.append(current.plan())
        children = current.children()
        pending += [children.apply(i) for i in range(children.size())]
    assert 0 < written <= versions.rdd.getNumPartitions()


def test_hot_task_in_a_batch(versions, completed_rows):
    batch = upsert.latest_in_batch(versions)
    target = completed_rows({"task_id": "hot", "task_name": "old", "estimated_minutes": 5.0})
    merged = upsert.merge_tasks(target, batch)
    hot = merged.filter("task_id = 'hot'").first()
    assert merged.count() == N - N // HOT_SHARE + 1
    assert hot.task_name is None and hot.estimated_minutes == 5.0


def test_hot_project_in_a_report(versions):
    rows = reports.report(views.unique_tasks(versions), "project").collect()
    assert {(r.project_name, r.tasks_count) for r in rows} == {
        ("P hot", 1),
        ("P cold", N - N // HOT_SHARE),
    }


def test_hot_parent_of_listed_ids(spark, versions):
    unique = views.unique_tasks(versions)
    ids = spark.createDataFrame([("hot",), ("1",)], "id string")
    assert audit.of_task_ids(unique, ids).count() == N - N // HOT_SHARE + 1


def test_hot_parent_of_subtasks_landed_apart(spark):
    """A third of all subtasks under one parent, joined with skew splitting switched on."""
    body = {f.name: f.dataType for f in schema.DETACHED_SUBTASK}
    children = spark.range(0, N, numPartitions=6).select(
        F.when(F.col("id") % HOT_SHARE == 0, "hot").otherwise(
            (F.col("id") % 100).cast("string")
        ).alias("parent_gid"),
        F.col("id").cast("string").alias("gid"),
        F.lit("n").alias("name"),
        F.lit(True).alias("completed"),
        F.lit("2024-01-01T00:00:00Z").alias("completed_at"),
    )
    for name, kind in body.items():
        if name not in children.columns:
            children = children.withColumn(name, F.lit(None).cast(kind))
    parents = spark.createDataFrame(
        [("p", "P", g, 1) for g in ["hot", *map(str, range(100))]],
        "project_gid string, project_name string, gid string, num_subtasks int",
    )
    for field in schema.SUBTASK:
        if field.name not in parents.columns:
            parents = parents.withColumn(field.name, F.lit(None).cast(field.dataType))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = normalize.completed_task_rows(normalize.task_items(parents, children))
        parent_ids = rows.select("parent_task_id", "task_id")
        found = Counter(r.parent_task_id for r in parent_ids.collect())
        plan = parent_ids._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert found["hot"] == N // HOT_SHARE and sum(found.values()) == N
    assert "skew=true" in plan
