"""Reconciliation of reported effort and profile of the assignee column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.functions.effort import label_from_hours, label_from_minutes
from effortlens.functions.timeutil import BUSINESS_ZONE, local_month, within_local_month
from effortlens.operators.reports import has_assignee

BASES = ("completed", "modified")
MAP_BITS = 1 << 23


def of_pair(unique: DataFrame, project: str, assignee: str) -> DataFrame:
    return unique.filter(
        (F.trim("project_name") == project) & (F.col("assignee_name") == assignee)
    )


def _slot(task_id: Column) -> Column:
    """A task id's place in the bit map, from 1 on."""
    return F.pmod(F.xxhash64(task_id), F.lit(MAP_BITS)) + 1


def id_map(ids: DataFrame) -> DataFrame:
    """Bit map of the ids in ``id``: at most ``MAP_BITS / 32768`` rows of 4 KiB, 1 MiB in all."""
    slot = _slot(F.col("id"))
    places = ids.select(
        F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit")
    )
    return places.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _is_marked(bits: Column, task_id: Column) -> Column:
    place = F.bitmap_bit_position(_slot(task_id)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), place % 8) == 1, F.lit(False))


def maybe_listed(tasks: DataFrame, ids: DataFrame) -> DataFrame:
    """Tasks whose own or parent's id may be among ``ids``; all others are certainly not.

    Decided where the tasks are read, from a broadcast map of fixed size, so that what is
    shuffled afterwards grows with the matches.
    """
    marked = tasks
    for name in ("task_id", "parent_task_id"):
        part = F.bitmap_bucket_number(_slot(F.col(name)))
        bits = F.broadcast(id_map(ids)).toDF(f"part_{name}", f"bits_{name}")
        marked = marked.join(bits, part == F.col(f"part_{name}"), "left")
    own, parent = (_is_marked(F.col(f"bits_{n}"), F.col(n)) for n in ("task_id", "parent_task_id"))
    return marked.filter(own | parent).select(*tasks.columns)


def of_task_ids(tasks: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Tasks listed by id, and subtasks of listed tasks, each once.

    A short list becomes a pushed filter. A frame of ids first drops nearly all other tasks by
    a bit map, then marks the tasks by two joins; a task without a parent is given a key of its
    own that no id can equal, so that absent parents are not all sent to one task.
    """
    if not isinstance(ids, DataFrame):
        wanted = [i.strip() for i in ids if i.strip()]
        if not wanted:
            return tasks
        return tasks.filter(
            F.col("task_id").isin(wanted) | F.col("parent_task_id").isin(wanted)
        )
    listed = ids.toDF("id").filter(F.col("id").isNotNull()).distinct()
    no_parent = F.concat(F.lit("\0"), F.col("task_id"))
    marked = (
        maybe_listed(tasks, listed)
        .withColumn("parent_key", F.coalesce(F.col("parent_task_id"), no_parent))
        .join(listed.toDF("own_match"), F.col("task_id") == F.col("own_match"), "left")
        .join(listed.toDF("parent_match"), F.col("parent_key") == F.col("parent_match"), "left")
    )
    matched = F.col("own_match").isNotNull() | F.col("parent_match").isNotNull()
    return marked.filter(matched).select(*tasks.columns)


def _basis(basis: str) -> str:
    if basis not in BASES:
        raise ValueError(f"basis must be one of {BASES}, got {basis!r}")
    return f"{basis}_at"


def effort_total(
    unique: DataFrame,
    project: str,
    assignee: str,
    month: str | None = None,
    basis: str = "completed",
    task_ids: Sequence[str] | DataFrame | None = None,
    zone: str = BUSINESS_ZONE,
) -> DataFrame:
    """Count, actual hours and estimated minutes of one pair, one row.

    Over all time, or over the month in which the tasks were completed or modified.
    """
    tasks = of_pair(unique, project, assignee)
    if month is not None:
        tasks = tasks.filter(within_local_month(F.col(_basis(basis)), month, zone))
    if task_ids is not None:
        tasks = of_task_ids(tasks, task_ids)
    zero = F.lit(0.0)
    totals = tasks.agg(
        F.count(F.lit(1)).alias("tasks_count"),
        F.sum(F.coalesce(F.col("actual_time"), zero)).alias("total_actual_hours"),
        F.sum(F.coalesce(F.col("estimated_time"), zero)).alias("total_estimated_minutes"),
    )
    return totals.withColumns(
        {
            "actual_label": label_from_hours(F.col("total_actual_hours")),
            "estimated_label": label_from_minutes(F.col("total_estimated_minutes")),
        }
    )


def effort_details(
    unique: DataFrame,
    project: str,
    assignee: str,
    month: str,
    basis: str = "completed",
    task_ids: Sequence[str] | DataFrame | None = None,
    zone: str = BUSINESS_ZONE,
) -> DataFrame:
    """The pair's tasks one by one, saying which of them belong to the month."""
    tasks = of_pair(unique, project, assignee)
    if task_ids is not None:
        tasks = of_task_ids(tasks, task_ids)

    def in_month(instant: str) -> Column:
        inside = within_local_month(F.col(instant), month, zone)
        return F.coalesce(inside, F.lit(False))

    listing = tasks.select(
        "task_id",
        "task_name",
        F.col("estimated_time").alias("estimated_minutes"),
        F.col("actual_time_raw").alias("actual_minutes"),
        label_from_minutes(F.col("estimated_time")).alias("estimated_label"),
        label_from_minutes(F.col("actual_time_raw")).alias("actual_label"),
        "completed_at",
        local_month(F.col("completed_at"), zone).alias("completed_month"),
        "modified_at",
        local_month(F.col("modified_at"), zone).alias("modified_month"),
        in_month(_basis(basis)).alias("within_month"),
    )
    return listing.orderBy(
        F.col("completed_at").asc_nulls_last(),
        F.col("modified_at").asc_nulls_last(),
        F.col("task_id").asc(),
    )


def assignee_quality(completed_tasks: DataFrame) -> DataFrame:
    """How complete the assignee column of the raw table is, one row."""
    name = F.col("assignee_name")

    def count_if(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return completed_tasks.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(name.isNull()).alias("null_assignees"),
        count_if(name == "").alias("empty_string_assignees"),
        count_if(has_assignee()).alias("valid_assignees"),
    )


def assignee_sample(completed_tasks: DataFrame, n: int = 10) -> DataFrame:
    """The first n distinct assignee names in order."""
    names = completed_tasks.filter(has_assignee()).select("assignee_name").distinct()
    return names.orderBy(F.col("assignee_name").asc()).limit(n)
