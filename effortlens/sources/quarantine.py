"""Landed lines that cannot be used: set aside with their source and reason, and counted."""

from __future__ import annotations

from contextlib import contextmanager
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.functions.timeutil import ntz_literal
from effortlens.operators.upsert import absent_rows
from effortlens.session import freed_shuffles
from effortlens.sources import folders
from effortlens.sources.landing import MALFORMED
from effortlens.sources.tables import StoredTable, may_be_sent

UNREADABLE = "not readable"
NO_KEY = "no key"


@dataclass(frozen=True)
class Accepted:
    """Usable rows, and how many others there were."""

    rows: DataFrame
    malformed: int = 0
    keyless: int = 0
    last_day: str | None = None  # latest landing day among the rows
    few: bool = False  # whether Spark may broadcast them


def refusal(keys: tuple[str, ...]) -> Column:
    """Why a landed row cannot be used; null where it can."""
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    return F.when(F.col(MALFORMED).isNotNull(), UNREADABLE).when(keyless, NO_KEY)


def refused_lines(refused: DataFrame, source: str, noticed_at: datetime) -> DataFrame:
    """Rows of the quarantine table from rows that have a ``refused_for``."""
    payload = [F.col(c) for c in refused.columns if c not in (MALFORMED, "refused_for")]
    line = F.coalesce(F.col(MALFORMED), F.to_json(F.struct(*payload)))
    lines = refused.select(line.alias("line"), F.col("refused_for").alias("reason"))
    counted = lines.groupBy("line", "reason").agg(F.count("*").alias("copies"))
    return counted.select(
        F.lit(source).alias("source"),
        F.sha2("line", 256).alias("line_sha256"),
        "line",
        "reason",
        "copies",
        ntz_literal(noticed_at).alias("noticed_at"),
    )


def set_aside(lines: DataFrame, table: StoredTable) -> None:
    """Add lines that the table does not hold yet; a line is noticed once."""
    table.merge(
        lines,
        lambda stored, new, small: stored.unionByName(absent_rows(new, stored, *table.layout.key)),
    )


@contextmanager
def accepted(
    landed: DataFrame, source: str, keys: tuple[str, ...], table: StoredTable, noticed_at: datetime
) -> Iterator[Accepted]:
    """The usable rows of a landing, parsed once and at rest while the context lasts.

    The others go to the quarantine table.
    """
    spark = landed.sparkSession
    folder = folders.new_below(table.path.rsplit("/", 1)[0] + "/_parsed")
    counts = Observation("lines")
    day = F.max("landed_on").cast("string") if "landed_on" in landed.columns else F.max(F.lit(None))
    marked = landed.withColumn("refused_for", refusal(keys)).observe(
        counts,
        F.count_if(F.col("refused_for") == UNREADABLE).alias("malformed"),
        F.count_if(F.col("refused_for") == NO_KEY).alias("keyless"),
        day.cast("string").alias("day"),
    )
    try:
        with freed_shuffles(spark):
            marked.write.option("compression", "zstd").parquet(folder)
        parsed = spark.read.schema(marked.schema).parquet(folder)
        seen = schema.figures_of(counts, malformed=0, keyless=0, day=None)
        if seen["malformed"] + seen["keyless"]:
            refused = parsed.filter(F.col("refused_for").isNotNull())
            set_aside(refused_lines(refused, source, noticed_at), table)
        good = parsed.filter(F.col("refused_for").isNull()).drop(MALFORMED, "refused_for")
        few = may_be_sent(spark, folder)
        yield Accepted(good, seen["malformed"], seen["keyless"], seen["day"], few)
    finally:
        folders.delete(spark, folder)
