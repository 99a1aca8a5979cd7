"""Stored totals per month, brought up to date month by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from effortlens.operators.reports import monthly_effort
from effortlens.operators.views import unique_tasks
from effortlens.plans.warehouse import Warehouse
from effortlens.sources import folders
from effortlens.sources.tables import UNDATED

_EFFORT = "project_name string, assignee_name string, tasks long, actual double, estimated double, month string"


def stored_effort(spark: SparkSession, house: Warehouse) -> DataFrame:
    """The finest totals of every month, as last brought up to date."""
    if not any("=" in n for n in folders.names_in(spark, house.monthly_effort)):
        return spark.createDataFrame([], _EFFORT)
    return spark.read.schema(_EFFORT).parquet(house.monthly_effort)


def stale_months(spark: SparkSession, house: Warehouse) -> tuple[list[str], int]:
    """Months that merges have touched since the totals were made, and the last merge's number.

    Each merge logs its months, those of replaced rows included, so a task that changes month
    makes both of them stale. Without totals all months are.
    """
    table = house.completed(spark)
    number = table.last_logged()[0]
    done = folders.read_text(spark, _done(house))
    if done is None:
        return [m for m in table.labels() if m != UNDATED], number
    later = table.log(after=int(done))
    months = later.select(F.explode("labels").alias("month")).distinct()
    return sorted(r.month for r in months.collect() if r.month != UNDATED), number


def _done(house: Warehouse) -> str:
    """Where the number of the last merge stands that the totals take account of."""
    return f"{house.monthly_effort}/_merged-until"


def month_totals(spark: SparkSession, house: Warehouse, months: list[str]) -> DataFrame:
    """Totals of the given months, from the partitions of these alone."""
    tasks = house.completed(spark).read(months)
    return monthly_effort(unique_tasks(tasks, one_row_per_task=True))


def refresh_effort(spark: SparkSession, house: Warehouse) -> list[str]:
    """Make the totals of stale months anew; which these were.

    The number is noted last, so a refresh that dies is done again in full.
    """
    house.completed(spark).recover()
    months, number = stale_months(spark, house)
    if months:
        totals = month_totals(spark, house, months)
        # A month's totals go to files of the advised size, whatever their number.
        held = totals.hint("rebalance", "month").write.mode("overwrite").partitionBy("month")
        held.option("partitionOverwriteMode", "dynamic").parquet(house.monthly_effort)
        table = house.completed(spark)
        for month in set(months) - set(table.labels()):
            folders.delete(spark, f"{house.monthly_effort}/month={month}")
    folders.write_text(spark, _done(house), str(number))
    return months
