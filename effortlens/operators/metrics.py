"""Figures of a sync run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.functions.timeutil import ntz_literal


def figures(required: list[str], counted: Column | None = None) -> list[Column]:
    """Rows, and rows that lack a required value; only of rows that count, where that is said."""
    counted = F.lit(True) if counted is None else counted
    broken = F.lit(False)
    for name in required:
        broken = broken | F.col(name).isNull()
    return [
        F.count_if(counted).alias("tasks_processed"),
        F.count_if(counted & broken).alias("errors"),
    ]


def run_metrics(batch: DataFrame, started: datetime, finished: datetime) -> DataFrame:
    """Rows processed and rows lacking a required value, with the run's bounds; one row."""
    return batch.agg(*figures(schema.required_columns(schema.COMPLETED_TASKS))).select(
        "tasks_processed",
        "errors",
        ntz_literal(started).alias("started_at"),
        ntz_literal(finished).alias("finished_at"),
    )


def observed(batch: DataFrame, observation: Observation) -> DataFrame:
    """The same figures gathered while the batch is written, without another pass."""
    return batch.observe(
        observation, *figures(schema.required_columns(schema.COMPLETED_TASKS))
    )
