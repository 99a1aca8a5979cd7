"""The newest landed version of every task and subtask, folded landing by landing.

What a run needs to know of the past stands in two tables with one row per key. Each run adds what
has landed since the last one: of folders partitioned by ``landed_on`` only the days from the last
one folded on are read, else all files. Versions that are already held, or are older, change
nothing, so a landing may be folded any number of times and in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from effortlens.functions.timeutil import ntz_literal
from effortlens.operators import scans
from effortlens.operators.upsert import replace_rows
from effortlens.plans.warehouse import Landing, Warehouse
from effortlens.sources import landing as land
from effortlens.sources.quarantine import accepted
from effortlens.sources.tables import StoredTable


@dataclass(frozen=True)
class Current:
    """All that is known now; ``subtasks`` only where they land apart."""

    tasks: DataFrame
    subtasks: DataFrame | None
    malformed: int
    keyless: int


def _fold(
    spark: SparkSession,
    read: Callable[[date | None], DataFrame],
    source: str,
    table: StoredTable,
    house: Warehouse,
    run_ts: datetime,
) -> tuple[int, int]:
    """Merge the newer versions of a landing, and say how many lines could not be used."""
    _, _, folded = table.last_logged()
    # A day may have gone on after it was folded, in another zone also the one before.
    since = date.fromisoformat(folded) - timedelta(days=1) if folded else None
    keys = table.layout.key
    with accepted(read(since), source, keys, house.quarantine(spark), run_ts) as landed:
        rows = landed.rows.drop("landed_on")
        newer = scans.newer_payloads(rows, table.read(), *keys, few=landed.few)
        table.merge(
            newer.withColumn("seen_at", ntz_literal(run_ts)),
            lambda stored, new, small: replace_rows(stored, new, *keys),
            stamp=run_ts,
            mark=landed.last_day,
        )
        return landed.malformed, landed.keyless


def fold_landing(
    spark: SparkSession, landing: Landing, house: Warehouse, run_ts: datetime
) -> Current:
    """Fold what has landed into the current tables and give them."""
    tasks = house.current_tasks(spark)
    broken = _fold(
        spark, lambda since: land.read_tasks(spark, landing.tasks, since), "tasks", tasks, house, run_ts
    )
    if not landing.subtasks:
        return Current(tasks.read(), None, *broken)
    apart = house.current_subtasks(spark)
    more = _fold(
        spark,
        lambda since: land.read_subtasks(spark, landing.subtasks, since),
        "subtasks",
        apart,
        house,
        run_ts,
    )
    return Current(tasks.read(), apart.read(), *(a + b for a, b in zip(broken, more, strict=True)))
