"""Batch preparation and the merge of a batch into stored rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.functions.timeutil import ntz_literal
from effortlens.operators.views import first_per_key, newest_first

# A batch value of null does not erase what is stored in these columns.
KEPT_WHEN_ABSENT = ("project_gid", "assignee_gid", "estimated_minutes", "actual_minutes")


def stage_batch(rows: DataFrame, run_ts: datetime) -> DataFrame:
    """Stamp the whole batch with one insertion instant and fit it to the table."""
    stamped = rows.withColumn("inserted_at", ntz_literal(run_ts))
    return schema.conform(stamped, schema.COMPLETED_TASKS)


def latest_in_batch(batch: DataFrame) -> DataFrame:
    """One row per task of a batch, by modification or else insertion instant."""
    recency = F.coalesce(F.col("modified_at"), F.col("inserted_at"))
    return first_per_key(batch, "task_id", newest_first(recency, F.col("inserted_at")))


def merge_tasks(
    target: DataFrame, batch: DataFrame, small_batch: bool = False, keep_newer: bool = False
) -> DataFrame:
    """Target after the batch: matched rows overwritten, others inserted or left alone.

    ``batch`` holds at most one row per task. The batch wins even when it is older, unless
    ``keep_newer`` is set: stored rows of a later modification then stay.
    By default one full outer join on the task shuffles both sides. With
    ``small_batch`` the target is probed instead, so that a batch whose measured size
    allows Spark to broadcast it leaves the target unshuffled and in its stored order.
    """
    columns = [c for c in target.columns if c != "task_id"]
    incoming = batch.select(
        "task_id", *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("in_batch")
    )

    wins = F.col("in_batch")
    if keep_newer:
        stale = F.col("modified_at") > F.col("new_modified_at")
        wins = wins & ~F.coalesce(stale, F.lit(False))

    def merged(name: str) -> Column:
        new, old = F.col(f"new_{name}"), F.col(name)
        if name in KEPT_WHEN_ABSENT:
            new = F.coalesce(new, old)
        return F.when(wins, new).otherwise(old).alias(name)

    result = [
        F.col("task_id") if c == "task_id" else merged(c) for c in target.columns
    ]
    if not small_batch:
        return target.join(incoming, "task_id", "full_outer").select(*result)
    updated = target.join(incoming, "task_id", "left").select(*result)
    known = target.join(batch.select("task_id"), "task_id", "left_semi").select("task_id")
    inserted = batch.join(known, "task_id", "left_anti").select(*target.columns)
    return updated.unionByName(inserted)


def backfill_minutes(tasks: DataFrame) -> DataFrame:
    """Fill missing minute columns from the older ones: minutes first, then hours."""
    return tasks.withColumns(
        {
            "estimated_minutes": F.coalesce("estimated_minutes", "estimated_time"),
            "actual_minutes": F.coalesce(
                F.col("actual_minutes"), F.col("actual_time_raw"), F.col("actual_time") * 60.0
            ),
        }
    )


def stage_entries(rows: DataFrame, run_ts: datetime) -> DataFrame:
    """Time-entry batch with its hours and stamp, the latest version of each entry only."""
    stamped = rows.withColumns(
        {
            "duration_hours": F.coalesce(F.col("duration_minutes"), F.lit(0.0)) / 60.0,
            "inserted_at": ntz_literal(run_ts),
        }
    )
    fitted = schema.conform(stamped, schema.TIME_ENTRIES)
    order = [
        F.col("modified_at").desc_nulls_last(),
        F.col("duration_minutes").desc_nulls_last(),
        F.coalesce(F.col("task_id"), F.lit("")).asc(),
    ]
    return first_per_key(fitted, "entry_id", order)


def absent_rows(rows: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key ``known`` does not hold."""
    return rows.join(known.select(*keys), list(keys), "left_anti").select(*rows.columns)


def replace_rows(existing: DataFrame, batch: DataFrame, *keys: str) -> DataFrame:
    """Stored rows with those of the batch replaced or added."""
    untouched = absent_rows(existing, batch, *keys)
    return untouched.unionByName(batch.select(*existing.columns))


def replace_entries(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored entries with those of the batch replaced or added."""
    return replace_rows(existing, batch, "entry_id")
