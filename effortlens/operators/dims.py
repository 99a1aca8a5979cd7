"""Project and user dimensions seeded from the latest task versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.functions.timeutil import ntz_literal


def upsert_projects(existing: DataFrame, unique: DataFrame, run_ts: datetime) -> DataFrame:
    """Refresh project names and reactivate what is seen; nothing is ever deactivated."""
    seen = _seen(unique, "project_gid", F.trim("project_name"))
    merged = _merge(existing, seen, "project_gid", "project_name", run_ts)
    return schema.conform(merged, schema.DIM_PROJECTS)


def upsert_users(existing: DataFrame, unique: DataFrame, run_ts: datetime) -> DataFrame:
    """Same for assignees; contact id and working hours of known users stay as they are."""
    seen = _seen(unique, "assignee_gid", F.col("assignee_name"))
    merged = _merge(existing, seen, "assignee_gid", "assignee_name", run_ts)
    return schema.conform(merged, schema.DIM_USERS)


def _seen(unique: DataFrame, key: str, name: Column) -> DataFrame:
    """Distinct non-empty keys with one name each; the greatest, so reruns agree."""
    keyed = unique.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return keyed.groupBy(key).agg(F.max(name).alias("seen_name"))


def _merge(
    existing: DataFrame, seen: DataFrame, key: str, name: str, run_ts: datetime
) -> DataFrame:
    now = ntz_literal(run_ts)
    marked = seen.withColumn("seen", F.lit(True))
    known = existing.withColumn("known", F.lit(True))
    is_seen = F.col("seen").isNotNull()
    return known.join(marked, key, "full_outer").withColumns(
        {
            name: F.when(is_seen, F.col("seen_name")).otherwise(F.col(name)),
            "active": F.when(is_seen, F.lit(True)).otherwise(F.col("active")),
            "created_at": F.when(F.col("known"), F.col("created_at")).otherwise(now),
            "updated_at": F.when(is_seen, now).otherwise(F.col("updated_at")),
        }
    )
