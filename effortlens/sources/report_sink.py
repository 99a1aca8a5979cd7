"""Published reports: CSV versions of which readers take the newest complete one."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from effortlens.operators.reports import OUTPUT_NAMES, sheet
from effortlens.sources import folders

_VERSION = re.compile(r"version=(\d+)")


def _versions(spark: SparkSession, output: str) -> list[int]:
    """Numbers of all versions, also of those that were never finished."""
    found = (_VERSION.fullmatch(n) for n in folders.names_in(spark, output))
    return sorted(int(m[1]) for m in found if m)


def _is_complete(spark: SparkSession, output: str, version: int) -> bool:
    return "_SUCCESS" in folders.names_in(spark, f"{output}/version={version}")


def published_folder(spark: SparkSession, kind: str, folder: str) -> str | None:
    """Where the report stands that readers are to take; null when there is none.

    The mark that Spark writes last makes a version the current one: a single new object, on
    every kind of storage, and nothing that is being read is touched.
    """
    output = f"{folder.rstrip('/')}/{OUTPUT_NAMES[kind]}"
    for version in reversed(_versions(spark, output)):
        if _is_complete(spark, output, version):
            return f"{output}/version={version}"
    return None


def read_report(spark: SparkSession, kind: str, folder: str, shown: T.StructType) -> DataFrame:
    """The current version of a report; no rows when none was published."""
    current = published_folder(spark, kind, folder)
    if current is None:
        return spark.createDataFrame([], shown)
    return spark.read.schema(shown).option("header", True).csv(current)


def publish_report(
    report_rows: DataFrame, kind: str, folder: str, updated_at: datetime, keep: int = 2
) -> bool:
    """Write a new version of a report; an empty result keeps what was published before.

    A version that a dying job left unfinished is never read, and goes with the next one, as do
    complete ones beyond the newest ``keep``.
    """
    if report_rows.isEmpty():
        return False
    spark = report_rows.sparkSession
    output = f"{folder.rstrip('/')}/{OUTPUT_NAMES[kind]}"
    before = _versions(spark, output)
    fresh = max(before, default=0) + 1
    published = sheet(report_rows, updated_at)
    published.write.option("header", True).csv(f"{output}/version={fresh}")
    complete = [v for v in before if _is_complete(spark, output, v)]
    for version in set(before) - set(complete[-(keep - 1) :] if keep > 1 else []):
        folders.delete(spark, f"{output}/version={version}")
    return True
