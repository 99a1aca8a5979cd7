"""Daily digest: one day against recent business days and the month so far."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.functions.timeutil import BUSINESS_ZONE, local_day, within_local_days
from effortlens.operators.ranking import top_by_hours
from effortlens.operators.reports import minute_sum

# Reach of the baseline, its size, and what counts as worth a warning.
BASELINE_REACH_DAYS = 30
BASELINE_SIZE = 7
SMALLEST_BASELINE = 1.0
WARNING_PERCENT = 50
WEEKEND = (1, 7)  # dayofweek: Sunday, Saturday


def on_days(
    unique: DataFrame, first: date, last: date, zone: str = BUSINESS_ZONE
) -> DataFrame:
    return unique.filter(within_local_days(F.col("completed_at"), first, last, zone))


def daily_totals(
    unique: DataFrame, first: date, last: date, zone: str = BUSINESS_ZONE
) -> DataFrame:
    """Counts and minutes per local day; at most one row per calendar day of the range."""
    return (
        on_days(unique, first, last, zone)
        .groupBy(local_day(F.col("completed_at"), zone).alias("day"))
        .agg(
            F.count("task_id").alias("tasks"),
            minute_sum("actual_minutes").alias("actual"),
            minute_sum("estimated_minutes").alias("estimated"),
        )
    )


def daily_kpi(unique: DataFrame, day: date, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Count and hours of one day, always one row; sums are null without tasks."""
    return on_days(unique, day, day, zone).agg(
        F.count("task_id").alias("tasks_count"),
        (minute_sum("actual_minutes") / 60.0).alias("total_hours"),
        (minute_sum("estimated_minutes") / 60.0).alias("estimated_hours"),
    )


def _is_baseline_day(day: date) -> Column:
    reach = F.col("day").between(
        F.lit(day - timedelta(days=BASELINE_REACH_DAYS)), F.lit(day - timedelta(days=1))
    )
    return reach & ~F.dayofweek("day").isin(*WEEKEND)


def business_day_baseline(
    unique: DataFrame, day: date, zone: str = BUSINESS_ZONE
) -> DataFrame:
    """Mean count and hours of the latest business days that have completions."""
    first = day - timedelta(days=BASELINE_REACH_DAYS)
    totals = daily_totals(unique, first, day - timedelta(days=1), zone)
    chosen = totals.filter(_is_baseline_day(day)).orderBy(F.col("day").desc())
    return chosen.limit(BASELINE_SIZE).agg(
        F.avg("tasks").alias("avg_tasks"),
        (F.sum("actual") / 60.0 / F.count("day")).alias("avg_hours"),
    )


def month_to_date(unique: DataFrame, day: date, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Hours and count from the first of the month to the day; zero when there are none."""
    return on_days(unique, day.replace(day=1), day, zone).agg(
        (F.coalesce(minute_sum("actual_minutes"), F.lit(0.0)) / 60.0).alias("mtd_hours"),
        F.count("task_id").alias("mtd_tasks"),
    )


def percent_change(value: Column, baseline: Column) -> Column:
    """Change against a baseline in percent, to one decimal with halves to even.

    Null for a baseline too small to compare with.
    """
    return F.when(
        baseline >= SMALLEST_BASELINE, F.bround((value - baseline) / baseline * 100.0, 1)
    )


def daily_figures(unique: DataFrame, day: date, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Day, month to date and baseline in one row from one pass over the tasks.

    The tasks are first reduced to one row per day, so the array that picks the
    baseline days never holds more than the thirty days of its reach.
    """
    month_start = day.replace(day=1)
    first = min(month_start, day - timedelta(days=BASELINE_REACH_DAYS))
    zero, none = F.lit(0.0), F.lit(0).cast("bigint")

    def over(condition: Column, column: str, default: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), default)

    today = F.col("day") == F.lit(day)
    this_month = F.col("day") >= F.lit(month_start)
    recent = F.collect_list(F.when(_is_baseline_day(day), F.struct("day", "tasks", "actual")))
    figures = daily_totals(unique, first, day, zone).agg(
        over(today, "tasks", none).alias("tasks_count"),
        (over(today, "actual", zero) / 60.0).alias("total_hours"),
        (over(today, "estimated", zero) / 60.0).alias("estimated_hours"),
        (over(this_month, "actual", zero) / 60.0).alias("mtd_hours"),
        over(this_month, "tasks", none).alias("mtd_tasks"),
        F.slice(F.sort_array(recent, asc=False), 1, BASELINE_SIZE).alias("recent"),
    )

    def mean(field: str) -> Column:
        total = F.aggregate("recent", zero, lambda acc, d: acc + d[field].cast("double"))
        return F.when(F.size("recent") > 0, total / F.size("recent"))

    averages = figures.withColumns(
        {
            "avg_tasks": F.coalesce(mean("tasks"), zero),
            "avg_hours": F.coalesce(mean("actual"), zero) / 60.0,
        }
    )
    compared = averages.withColumns(
        {
            "tasks_vs": percent_change(F.col("tasks_count"), F.col("avg_tasks")),
            "hours_vs": percent_change(F.col("total_hours"), F.col("avg_hours")),
        }
    )
    strong = [
        F.coalesce(F.abs(F.col(c)) >= WARNING_PERCENT, F.lit(False))
        for c in ("tasks_vs", "hours_vs")
    ]
    return compared.withColumn("warn", strong[0] | strong[1]).drop("recent")


def daily_deviation(unique: DataFrame, day: date, zone: str = BUSINESS_ZONE) -> DataFrame:
    """The day against its baseline, with a warning on a strong deviation."""
    return daily_figures(unique, day, zone).select(
        "tasks_count", "total_hours", "avg_tasks", "avg_hours", "tasks_vs", "hours_vs", "warn"
    )


def daily_digest(unique: DataFrame, day: date, zone: str = BUSINESS_ZONE) -> DataFrame:
    """The digest row: a day without completions shows the month to date only."""
    figures = daily_figures(unique, day, zone)
    is_empty = (F.col("tasks_count") == 0) & (F.col("total_hours") == 0.0)
    both = F.col("tasks_vs").isNotNull() & F.col("hours_vs").isNotNull()
    return figures.select(
        F.lit(day.isoformat()).alias("day"),
        F.when(is_empty, "mtd_only").otherwise("normal").alias("mode"),
        "tasks_count",
        F.round("total_hours", 2).alias("total_hours"),
        F.round("estimated_hours", 2).alias("estimated_hours"),
        F.round("mtd_hours", 2).alias("mtd_hours"),
        "mtd_tasks",
        "tasks_vs",
        "hours_vs",
        (both & ~is_empty).alias("comparison_shown"),
        (F.col("warn") & ~is_empty).alias("warn"),
    )


def top_projects(
    unique: DataFrame, day: date, n: int = 5, zone: str = BUSINESS_ZONE
) -> DataFrame:
    return top_by_hours(on_days(unique, day, day, zone), "project_name", n)


def top_assignees(
    unique: DataFrame, day: date, n: int = 5, zone: str = BUSINESS_ZONE
) -> DataFrame:
    return top_by_hours(on_days(unique, day, day, zone), "assignee_name", n)
