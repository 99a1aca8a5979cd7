"""Landed JSON-lines payloads, read with declared schemas (no inference pass).

Every reader adds ``MALFORMED``: the text of a line that is no JSON object of the declared schema,
null for good lines.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from effortlens import schema

MALFORMED = "malformed_line"


def _with_malformed(fields: T.StructType) -> T.StructType:
    return T.StructType([*fields, T.StructField(MALFORMED, T.StringType())])


def _read(
    spark: SparkSession, path: str, fields: T.StructType, landed_since: date | None = None
) -> DataFrame:
    reader = spark.read.schema(_with_malformed(fields))
    landed = reader.option("columnNameOfCorruptRecord", MALFORMED).json(path)
    if landed_since is not None and "landed_on" in landed.columns:
        landed = landed.filter(F.col("landed_on") >= F.lit(landed_since))
    return landed


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schema.PROJECT)


def read_tasks(spark: SparkSession, path: str, landed_since: date | None = None) -> DataFrame:
    """One line per project and parent task, its subtasks inside.

    Folders may be partitioned by ``landed_on=YYYY-MM-DD``; with a day given, only those
    of that day and later are listed and read.
    """
    return _read(spark, path, schema.TASK, landed_since)


def read_subtasks(spark: SparkSession, path: str, landed_since: date | None = None) -> DataFrame:
    """One line per subtask with its parent's id, for payloads landed apart."""
    return _read(spark, path, schema.DETACHED_SUBTASK, landed_since)


def read_time_entries(spark: SparkSession, path: str) -> DataFrame:
    """Time entries; below ``entered_on=`` folders, a day's filter is a filter of folders.

    The folder's name then stands for the field, as text: days that cannot be parsed stay
    what they are, and are as much outside of every range as they are in a line.
    """
    return _read(spark, path, schema.TIME_ENTRY)


def _stream(
    spark: SparkSession, path: str, fields: T.StructType, max_files_per_trigger: int | None
) -> DataFrame:
    reader = spark.readStream.schema(_with_malformed(fields))
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def stream_tasks(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The task landing folder as a stream of new files."""
    return _stream(spark, path, schema.TASK, max_files_per_trigger)


def stream_subtasks(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The landing folder of detached subtasks as a stream of new files."""
    return _stream(spark, path, schema.DETACHED_SUBTASK, max_files_per_trigger)
