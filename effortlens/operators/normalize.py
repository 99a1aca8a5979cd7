"""Nested task and time-entry payloads to flat rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.functions.effort import (
    actual_from,
    estimate_from,
    has_effort,
    readable_fields,
)
from effortlens.functions.timeutil import ntz_literal, parse_day, parse_instant

SUBTASK_PREFIX = "[Subtask] "  # fixed value

_BODY = [field.name for field in schema.SUBTASK]
# Of payloads that ``facts`` has read.
_READ = ["assignee_name", "assignee_gid", "estimated_minutes", "actual_minutes"]


def task_items(tasks: DataFrame, subtasks: DataFrame | None = None) -> DataFrame:
    """One row per task and per subtask, subtasks carrying their parent's project.

    Subtasks are read only for parents that announce some. By default they sit in the
    parent's ``subtasks`` array, and parents and subtasks leave a single pass over the
    input. When they were landed on their own, pass them as ``subtasks``: they are then
    equi-joined to their parents, so no parent's subtasks are ever gathered in one row.
    """
    if subtasks is not None:
        return _items_from_two_inputs(tasks, subtasks)

    own = F.struct(*[F.col(c) for c in _BODY], F.lit(False).alias("is_subtask"))
    nested = F.transform(
        F.col("subtasks"),
        lambda s: F.struct(*[s[c].alias(c) for c in _BODY], F.lit(True).alias("is_subtask")),
    )
    announced = F.when(F.col("num_subtasks") > 0, F.coalesce(nested, F.array()))
    items = tasks.select(
        "project_gid",
        "project_name",
        F.col("gid").alias("holder_gid"),
        F.explode(F.concat(F.array(own), F.coalesce(announced, F.array()))).alias("item"),
    )
    return items.select(
        "project_gid",
        "project_name",
        "item.*",
        F.when(F.col("item.is_subtask"), F.col("holder_gid")).alias("parent_task_id"),
    )


def _items_from_two_inputs(tasks: DataFrame, subtasks: DataFrame) -> DataFrame:
    return own_items(tasks).unionByName(child_items(announcing(tasks), subtasks))


def _body(payloads: DataFrame) -> list[str]:
    return [c for c in (*_BODY, *_READ) if c in payloads.columns]


def own_items(tasks: DataFrame) -> DataFrame:
    """One row per task, without its subtasks."""
    return tasks.select(
        "project_gid",
        "project_name",
        *_body(tasks),
        F.lit(False).alias("is_subtask"),
        F.lit(None).cast("string").alias("parent_task_id"),
    )


def announcing(tasks: DataFrame) -> DataFrame:
    """What subtasks need of the parents that say they have some."""
    parents = tasks.filter(F.col("num_subtasks") > 0)
    return parents.select("project_gid", "project_name", F.col("gid").alias("parent_gid"))


def child_items(
    parents: DataFrame, subtasks: DataFrame, also: tuple[str, ...] = ()
) -> DataFrame:
    """One row per subtask and project of its parent; ``also`` names further columns."""
    return subtasks.join(parents, "parent_gid").select(
        "project_gid",
        "project_name",
        *_body(subtasks),
        F.lit(True).alias("is_subtask"),
        F.col("parent_gid").alias("parent_task_id"),
        *also,
    )


def fresh_items(tasks: DataFrame, subtasks: DataFrame | None, fresh: Column, new: Column) -> DataFrame:
    """Items whose payload, or whose parent's, is fresh, of all tasks and subtasks now known.

    ``fresh`` is a condition over tasks, ``new`` one over subtasks. A new subtask meets every
    known parent, a fresh parent every known subtask; each pair comes once.
    """
    changed = tasks.filter(fresh)
    if subtasks is None:
        return task_items(changed)
    later = child_items(announcing(tasks), subtasks.filter(new))
    return task_items(changed, subtasks.filter(~new)).unionByName(later)


def with_effort(items: DataFrame) -> DataFrame:
    """Add estimated and actual minutes; a native actual, even zero, beats a parsed one."""
    readable = items.withColumn("readable", readable_fields(F.col("custom_fields")))
    return readable.select(
        *items.columns,
        estimate_from(F.col("readable")).alias("estimated_minutes"),
        F.coalesce(F.col("actual_time_minutes"), actual_from(F.col("readable"))).alias(
            "actual_minutes"
        ),
    )


def _display_name() -> Column:
    name = F.col("name")
    return F.when(F.col("is_subtask"), F.concat(F.lit(SUBTASK_PREFIX), name)).otherwise(name)


def is_completed_row(include_incomplete_subtasks: bool = False) -> Column:
    """Items that belong in the completed-task table.

    Incomplete subtasks (never parents) join in when asked for; their
    ``completed_at`` may then be null.
    """
    keep = F.col("completed") & F.col("completed_at").isNotNull()
    return keep | F.col("is_subtask") if include_incomplete_subtasks else keep


def completed_task_rows(
    items: DataFrame, include_incomplete_subtasks: bool = False
) -> DataFrame:
    """Completed tasks in the shape of the completed-task table, not yet stamped."""
    return task_rows(completed_task_facts(items, include_incomplete_subtasks))


def completed_task_facts(
    items: DataFrame, include_incomplete_subtasks: bool = False
) -> DataFrame:
    """What ``task_rows`` makes rows of completed tasks from."""
    return task_facts(items.filter(is_completed_row(include_incomplete_subtasks)))


def facts(payloads: DataFrame) -> DataFrame:
    """Payloads or items with what is read out of their fields instead of these.

    That is less to carry through joins and shuffles than texts and nested fields.
    """
    rest = [c for c in payloads.columns if c not in _BODY]
    return with_effort(payloads).select(
        *rest,
        "gid",
        "name",
        "completed",
        F.col("assignee.name").alias("assignee_name"),
        F.col("assignee.gid").alias("assignee_gid"),
        parse_instant(F.col("completed_at")).alias("completed_at"),
        parse_instant(F.col("created_at")).alias("created_at"),
        parse_day(F.col("due_on")).alias("due_on"),
        parse_instant(F.col("modified_at")).alias("modified_at"),
        "estimated_minutes",
        "actual_minutes",
    )


def task_facts(items: DataFrame, *also: str) -> DataFrame:
    """Items, or facts of items, of any state: all that their rows can be made from.

    Columns named in ``also`` are taken along.
    """
    read = items if "estimated_minutes" in items.columns else facts(items)
    return read.select(
        F.col("gid").alias("task_id"),
        _display_name().alias("task_name"),
        "project_gid",
        "project_name",
        "assignee_name",
        "assignee_gid",
        "completed_at",
        "created_at",
        "due_on",
        "modified_at",
        "estimated_minutes",
        "actual_minutes",
        "is_subtask",
        "parent_task_id",
        *also,
    )


def task_rows(made_from: DataFrame) -> DataFrame:
    """Rows in the shape of the completed-task table, with the columns that repeat others.

    To be called on ``task_facts`` when these have been shuffled, since it only adds to them.
    """
    return made_from.select(
        "task_id",
        "task_name",
        F.col("project_gid").alias("project_id"),
        "project_gid",
        "project_name",
        "assignee_name",
        "assignee_gid",
        "completed_at",
        "created_at",
        "due_on",
        "modified_at",
        F.col("estimated_minutes").alias("estimated_time"),
        (F.col("actual_minutes") / 60.0).alias("actual_time"),
        F.col("actual_minutes").alias("actual_time_raw"),
        "estimated_minutes",
        "actual_minutes",
        "is_subtask",
        "parent_task_id",
    )


def open_task_rows(items: DataFrame) -> DataFrame:
    """Incomplete tasks and subtasks as flat rows, before the snapshot stamps."""
    rows = with_effort(items.filter(F.col("completed").isNull() | ~F.col("completed")))
    return rows.select(
        F.col("gid").alias("task_id"),
        _display_name().alias("task_name"),
        "project_gid",
        "project_name",
        F.col("assignee.gid").alias("assignee_gid"),
        F.col("assignee.name").alias("assignee_name"),
        parse_day(F.col("due_on")).alias("due_on"),
        parse_instant(F.col("created_at")).alias("created_at"),
        parse_instant(F.col("modified_at")).alias("modified_at"),
        has_effort(F.col("estimated_minutes"), F.col("actual_minutes")).alias(
            "has_time_fields"
        ),
        "estimated_minutes",
        "actual_minutes",
    )


def snapshot_rows(open_rows: DataFrame, as_of: date, taken_at: datetime) -> DataFrame:
    """Stamp open rows with the snapshot day and whether they were overdue on it."""
    stamped = open_rows.withColumns(
        {
            "snapshot_date": F.lit(as_of),
            "snapshot_at": ntz_literal(taken_at),
            "is_overdue": F.coalesce(F.col("due_on") < F.lit(as_of), F.lit(False)),
        }
    )
    return schema.conform(stamped, schema.OPEN_TASKS_SNAPSHOT)


def time_entry_rows(entries: DataFrame) -> DataFrame:
    """Time-entry payloads as flat rows; a missing nested object leaves its columns null."""
    return entries.select(
        F.col("gid").alias("entry_id"),
        F.col("task.gid").alias("task_id"),
        F.col("task.name").alias("task_name"),
        F.col("attributed_project.gid").alias("project_id"),
        F.col("attributed_project.name").alias("project_name"),
        F.col("user.name").alias("user_name"),
        parse_day(F.col("entered_on")).alias("entered_on"),
        F.col("duration_minutes").cast("double").alias("duration_minutes"),
        parse_instant(F.col("created_at")).alias("created_at"),
        parse_instant(F.col("modified_at")).alias("modified_at"),
    )
