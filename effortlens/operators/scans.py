"""Which landed or stored rows a run has to look at."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from effortlens.functions.timeutil import (
    BUSINESS_ZONE,
    iso_millis,
    local_today,
    ntz_literal,
    parse_day,
    parse_instant,
)

# Cutoffs used when nothing narrower is known.
BEGINNING_OF_TIME = datetime(1970, 1, 1)
FULL_SYNC_START = datetime(2023, 1, 1)


def sync_watermark(stored: DataFrame) -> DataFrame:
    """Latest modification held, one row; null when nothing is stored."""
    latest = stored.agg(F.max("modified_at").alias("latest"))
    return latest.select(iso_millis(F.col("latest")).alias("last_modified"))


def completed_since_cutoff(
    watermark: datetime | None = None,
    override: datetime | None = None,
    backfill: bool = False,
    full_sync: bool = False,
) -> datetime:
    """Cutoff of the completed-task scan.

    A backfill ignores the watermark; otherwise a watermark, when there is one and
    no full sync is asked for, takes precedence over an explicit override.
    """
    if override is None and full_sync:
        override = BEGINNING_OF_TIME
    if backfill:
        return override or BEGINNING_OF_TIME
    if watermark is not None and not full_sync:
        return watermark
    return override or FULL_SYNC_START


def completed_since(tasks: DataFrame, cutoff: datetime, by: str = "completed") -> DataFrame:
    """Payloads still open, or completed at or after the cutoff.

    ``by="modified"`` tests the modification instant instead, which also catches
    edits to tasks that were completed before the cutoff.
    """
    if by not in ("completed", "modified"):
        raise ValueError(f"by must be 'completed' or 'modified', got {by!r}")
    recent = parse_instant(F.col(f"{by}_at")) >= ntz_literal(cutoff)
    is_open = F.col("completed").isNull() | ~F.col("completed")
    return tasks.filter(is_open | recent)


def _instant_of(payloads: DataFrame) -> Column:
    """When a payload was modified last, itself or a subtask inside it."""
    instant = parse_instant(F.col("modified_at"))
    if "subtasks" in payloads.columns:
        inner = F.transform("subtasks", lambda s: parse_instant(s["modified_at"]))
        instant = F.greatest(instant, F.array_max(inner))
    return instant


def _ties(payloads: DataFrame, keys: tuple[str, ...]) -> list[str]:
    """Plain fields, which tell versions of one instant apart."""
    plain = [f.name for f in payloads.schema if f.dataType.typeName() in ("string", "boolean")]
    return [c for c in plain if c not in keys]


def _newest(versions: DataFrame, keys: tuple[str, ...], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return versions.withColumn("version_rank", rank).filter("version_rank = 1").drop("version_rank")


def latest_payloads(payloads: DataFrame, *keys: str) -> DataFrame:
    """The newest landed version of each key.

    Landing folders keep every version; what is open or active *now* is known from the
    newest one only. Each map task keeps one row per key before anything is shuffled, and a row
    holds nothing twice: versions are put in order by its own fields.
    """
    order = [_instant_of(payloads).desc(), *[F.col(c).desc() for c in _ties(payloads, keys)]]
    return _newest(payloads, keys, order)


def newer_payloads(payloads: DataFrame, known: DataFrame, *keys: str, few: bool = False) -> DataFrame:
    """The newest landed version of each key that ``known`` lacks or holds in an older version.

    Landed and known versions are put in order together, so that either is shuffled once; of
    ``known`` only keys and versions are read. With ``few`` payloads (their keys may be sent to all
    tasks) known versions that meet none of them are not shuffled at all.
    """
    ties = _ties(payloads, keys)
    held = known.select(*keys, *ties, _instant_of(known).alias("instant"), F.lit(True).alias("held"))
    if few:
        held = held.join(payloads.select(*keys), list(keys), "left_semi")
    offered = payloads.withColumns({"instant": _instant_of(payloads), "held": F.lit(False)})
    versions = offered.unionByName(held, allowMissingColumns=True)
    # Of equal versions the one that is held stays.
    order = [F.col(c).desc() for c in ("instant", *ties, "held")]
    return _newest(versions, keys, order).filter(~F.col("held")).select(*payloads.columns)


def still_open(tasks: DataFrame) -> DataFrame:
    """Payloads of incomplete tasks only."""
    return tasks.filter(F.col("completed").isNull() | ~F.col("completed"))


def entries_between(
    entries: DataFrame,
    first: date,
    last: date,
    user_gid: str | None = None,
    project_gid: str | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Time-entry payloads entered in ``[first, last]``, optionally of one user or project.

    The day's condition uses ``entered_on`` alone, so that it decides which folders are read
    where entries are partitioned by it. Of these, rows for which ``keep`` holds stay anyway.
    """
    day = parse_day(F.col("entered_on"))
    inside = day.between(F.lit(first), F.lit(last))
    whose = F.lit(True)
    if user_gid:
        whose = whose & (F.col("user.gid") == user_gid)
    if project_gid:
        whose = whose & (F.col("attributed_project.gid") == project_gid)
    if keep is None:
        return entries.filter(inside).filter(whose)
    # A line that cannot be read has no day, unless its folder names one.
    return entries.filter(inside | F.col("entered_on").isNull()).filter((inside & whose) | keep)


def yesterday(now: datetime, zone: str = BUSINESS_ZONE) -> date:
    """The day before the current calendar day of the zone."""
    return local_today(now, zone) - timedelta(days=1)
