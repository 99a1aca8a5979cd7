"""Declared schemas of the landed payloads and of the stored tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    parsed = T.StructType()
    for part in columns.split(","):
        name, kind = part.split()
        parsed.add(T.StructField(name, _TYPES[kind], name not in required))
    return parsed


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "date": T.DateType(),
    "instant": T.TimestampNTZType(),
}

# Landed payloads (JSON lines). Instants and days stay text until they are normalised.
PROJECT = _struct(
    "gid string, name string, archived boolean, created_at string, modified_at string"
)

PERSON = _struct("gid string, name string")
CUSTOM_FIELD = _struct(
    "name string, number_value double, text_value string, display_value string"
)

_TASK_BODY = [
    T.StructField("gid", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("completed", T.BooleanType()),
    T.StructField("completed_at", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("due_on", T.StringType()),
    T.StructField("modified_at", T.StringType()),
    T.StructField("assignee", PERSON),
    T.StructField("actual_time_minutes", T.DoubleType()),
    T.StructField("custom_fields", T.ArrayType(CUSTOM_FIELD)),
]
SUBTASK = T.StructType(list(_TASK_BODY))
# Subtasks landed on their own, one row each, instead of inside their parent's row.
DETACHED_SUBTASK = T.StructType([T.StructField("parent_gid", T.StringType()), *_TASK_BODY])
TASK = T.StructType(
    [
        T.StructField("project_gid", T.StringType()),
        T.StructField("project_name", T.StringType()),
        *_TASK_BODY,
        T.StructField("num_subtasks", T.IntegerType()),
        T.StructField("subtasks", T.ArrayType(SUBTASK)),
    ]
)

TIME_ENTRY = T.StructType(
    [
        T.StructField("gid", T.StringType()),
        T.StructField("entered_on", T.StringType()),
        T.StructField("duration_minutes", T.DoubleType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("modified_at", T.StringType()),
        T.StructField("task", PERSON),
        T.StructField("user", PERSON),
        T.StructField("attributed_project", PERSON),
    ]
)

# The newest landed version of a payload, and when the run that first saw it started.
_SEEN = T.StructField("seen_at", T.TimestampNTZType())


def _keyed(payload: T.StructType, *keys: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, f.name not in keys) for f in payload])


CURRENT_TASK = _keyed(TASK, "gid").add(_SEEN)
CURRENT_SUBTASK = _keyed(DETACHED_SUBTASK, "gid", "parent_gid").add(_SEEN)

# Stored tables.
QUARANTINE = _struct(
    "source string, line_sha256 string, line string, reason string, copies long, noticed_at instant",
    required=("source", "line_sha256"),
)

COMPLETED_TASKS = _struct(
    "task_id string, task_name string, project_id string, project_name string, "
    "assignee_name string, completed_at instant, created_at instant, due_on date, "
    "modified_at instant, inserted_at instant, estimated_time double, actual_time double, "
    "actual_time_raw double, is_subtask boolean, parent_task_id string, "
    "project_gid string, assignee_gid string, estimated_minutes double, "
    "actual_minutes double",
    required=("task_id", "inserted_at"),
)

OPEN_TASKS_SNAPSHOT = _struct(
    "snapshot_date date, snapshot_at instant, task_id string, task_name string, "
    "project_gid string, project_name string, assignee_gid string, assignee_name string, "
    "due_on date, created_at instant, modified_at instant, is_overdue boolean, "
    "has_time_fields boolean, estimated_minutes double, actual_minutes double",
    required=("snapshot_date", "snapshot_at", "task_id"),
)

TIME_ENTRIES = _struct(
    "entry_id string, task_id string, task_name string, project_id string, "
    "project_name string, user_name string, entered_on date, duration_minutes double, "
    "duration_hours double, created_at instant, modified_at instant, inserted_at instant",
    required=("entry_id", "inserted_at"),
)

DIM_PROJECTS = _struct(
    "project_gid string, project_name string, active boolean, created_at instant, "
    "updated_at instant",
    required=("project_gid",),
)

DIM_USERS = _struct(
    "assignee_gid string, assignee_name string, slack_user_id string, "
    "work_hours_per_day double, active boolean, created_at instant, updated_at instant",
    required=("assignee_gid",),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring a frame to a table schema: add missing columns as null, drop unknown ones."""
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema])


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]


def count_rejected(df: DataFrame, schema: T.StructType, observation: Observation) -> DataFrame:
    """Only complete rows, see below; the others are counted as ``rejected`` on the way."""
    complete = F.lit(True)
    for name in required_columns(schema):
        complete = complete & F.col(name).isNotNull()
    counted = df.observe(observation, F.count(F.when(~complete, 1)).alias("rejected"))
    return reject_null_keys(counted, schema)


def figures_of(observation: Observation, **without: object) -> dict:
    """Figures of an action that has run; ``without`` where Spark saw that there was no input.

    A plan that is known to be empty is not run, and then nothing is observed.
    """
    try:
        found = observation.get
    except Py4JJavaError:
        found = {}
    return {**without, **{k: v for k, v in found.items() if v is not None}}


def reject_null_keys(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep only rows whose required columns are all present."""
    for name in required_columns(schema):
        df = df.filter(F.col(name).isNotNull())
    return df
