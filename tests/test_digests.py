"""Edges of the reports and digests."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from effortlens import schema
from effortlens.operators import audit, daily, dims, monthly, open_tasks, reports, views, weekly
from effortlens.operators.metrics import run_metrics

WEDNESDAY = date(2024, 5, 15)


@pytest.fixture
def worked(completed_rows):
    """Unique tasks from (day, minutes, ...) with one task per entry, at noon Tokyo time."""

    def build(*entries):
        rows = []
        for i, (day, minutes, *rest) in enumerate(entries):
            noon = datetime(day.year, day.month, day.day, 3)
            extra = rest[0] if rest else {}
            rows.append(
                {"task_id": f"t{i}", "completed_at": noon, "modified_at": noon,
                 "project_name": "P", "assignee_name": "Ann",
                 "actual_minutes": None if minutes is None else float(minutes), **extra}
            )
        return views.unique_tasks(completed_rows(*rows))

    return build


def weekdays_before(day, count):
    days = []
    while len(days) < count:
        day -= timedelta(days=1)
        if day.weekday() < 5:
            days.append(day)
    return days


def test_latest_version_wins_and_is_stable(completed_rows):
    day = datetime(2024, 5, 1)
    tasks = completed_rows(
        {"task_id": "a", "completed_at": day, "modified_at": day, "project_name": " x "},
        {"task_id": "a", "completed_at": day, "modified_at": day + timedelta(days=1),
         "project_name": " y "},
        # A newer version without completion does not count.
        {"task_id": "a", "modified_at": day + timedelta(days=9), "project_name": "z"},
        {"task_id": "b", "modified_at": day},
        {"task_id": "c", "completed_at": day, "modified_at": None, "project_name": "n"},
    )
    unique = views.unique_tasks(tasks)
    assert {r.task_id: r.project_name for r in unique.collect()} == {"a": "y", "c": "n"}
    again = views.unique_tasks(unique)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(
        map(tuple, unique.collect()), key=str
    )


def test_both_view_forms_agree_on_a_unique_table(completed_rows):
    day = datetime(2024, 5, 1)
    tasks = completed_rows({"task_id": "a", "completed_at": day}, {"task_id": "b"})
    ranked = views.unique_tasks(tasks).collect()
    assert views.unique_tasks(tasks, one_row_per_task=True).collect() == ranked


@pytest.mark.parametrize(
    "baseline_tasks, today, expected, warn",
    [
        (10, 15, 50.0, True),
        (10, 5, -50.0, True),
        (10, 14, 40.0, False),
        (16, 17, 6.2, False),  # 6.25, halves to even
        (0, 3, None, False),
    ],
)
def test_deviation(worked, baseline_tasks, today, expected, warn):
    entries = [
        (d, 0) for d in weekdays_before(WEDNESDAY, 7) for _ in range(baseline_tasks)
    ] + [(WEDNESDAY, 0)] * today
    row = daily.daily_deviation(worked(*entries), WEDNESDAY).first()
    assert (row.tasks_vs, row.warn) == (expected, warn)
    assert row.hours_vs is None


@pytest.mark.parametrize(
    "minutes_each, today, expected, warn",
    [
        (600, 900, 50.0, True),
        (600, 894, 49.0, False),
        (59.99999, 600, None, False),  # just short of an hour
        (54, 600, None, False),  # mean of 0.9 h is too small to compare with
        (60, 60, 0.0, False),
    ],
)
def test_hour_deviation(worked, minutes_each, today, expected, warn):
    entries = [(d, minutes_each) for d in weekdays_before(WEDNESDAY, 7)]
    row = daily.daily_deviation(worked(*entries, (WEDNESDAY, today)), WEDNESDAY).first()
    assert row.hours_vs == expected and row.tasks_vs == 0.0
    assert row.warn is warn


def test_baseline_skips_weekends_and_days_without_rows(worked):
    saturday = WEDNESDAY - timedelta(days=4)
    far = WEDNESDAY - timedelta(days=31)
    unique = worked(
        (saturday, 6000),
        (far, 6000),
        (WEDNESDAY, 6000),
        (WEDNESDAY - timedelta(days=1), 60),
        (WEDNESDAY - timedelta(days=9), 180),
        (WEDNESDAY - timedelta(days=30), 120),
    )
    row = daily.business_day_baseline(unique, WEDNESDAY).first()
    assert (row.avg_tasks, row.avg_hours) == (1.0, 2.0)
    figures = daily.daily_figures(unique, WEDNESDAY).first()
    assert (figures.avg_tasks, figures.avg_hours) == (1.0, 2.0)


def test_baseline_takes_the_seven_latest_days(worked):
    days = weekdays_before(WEDNESDAY, 10)
    unique = worked(*[(d, 60 if i < 7 else 6000) for i, d in enumerate(days)])
    assert daily.business_day_baseline(unique, WEDNESDAY).first().avg_hours == 1.0
    assert daily.daily_figures(unique, WEDNESDAY).first().avg_hours == 1.0


def test_day_without_completions_shows_month_to_date(worked):
    unique = worked((date(2024, 5, 1), 90), (date(2024, 4, 30), 60))
    row = daily.daily_digest(unique, WEDNESDAY).first()
    assert (row.mode, row.mtd_hours, row.mtd_tasks) == ("mtd_only", 1.5, 1)
    assert not row.comparison_shown and not row.warn and row.day == "2024-05-15"
    kpi = daily.daily_kpi(unique, WEDNESDAY).first()
    assert (kpi.tasks_count, kpi.total_hours) == (0, None)
    nothing = daily.daily_digest(unique.limit(0), WEDNESDAY).first()
    assert (nothing.mode, nothing.mtd_hours, nothing.mtd_tasks) == ("mtd_only", 0.0, 0)
    assert daily.month_to_date(unique.limit(0), WEDNESDAY).first() == (0.0, 0)


def test_day_with_unmeasured_tasks_is_normal(worked):
    row = daily.daily_digest(worked((WEDNESDAY, None)), WEDNESDAY).first()
    assert (row.mode, row.tasks_count, row.total_hours) == ("normal", 1, 0.0)


def test_monthly_kpi_without_tasks(worked):
    empty = worked((WEDNESDAY, 60)).limit(0)
    assert tuple(monthly.monthly_kpi(empty, "2024-05").first()) == ("2024-05", 0, None, None)
    assert tuple(monthly.monthly_kpi(empty).first()) == (None, 0, None, None)
    with pytest.raises(ValueError):
        monthly.monthly_kpi(empty, "2024-05-01")


def test_latest_month_is_local(worked, completed_rows):
    tasks = completed_rows({"task_id": "a", "completed_at": datetime(2024, 4, 30, 15)})
    assert monthly.latest_month(views.unique_tasks(tasks)).first().month == "2024-05"


def test_top_of_the_latest_month(worked):
    may, june = date(2024, 5, 2), date(2024, 6, 3)
    unique = worked(
        (may, 900, {"project_name": "old", "assignee_name": "Ann"}),
        (june, 60, {"project_name": "a", "assignee_name": None}),
        (june, 90, {"project_name": "b", "assignee_name": ""}),
    )
    assert [tuple(r) for r in monthly.top_projects(unique).collect()] == [
        ("b", 1, 1.5),
        ("a", 1, 1.0),
    ]
    # Nobody is named in the latest month, so nobody is listed for it.
    assert monthly.top_assignees(unique).count() == 0
    named = unique.unionByName(
        worked((june, 5, {"assignee_name": "Bob"})).withColumn("task_id", F.lit("z"))
    )
    assert [tuple(r) for r in monthly.top_assignees(named).collect()] == [("Bob", 1, 5 / 60.0)]
    assert [r.assignee_name for r in monthly.top_assignees(named, "2024-05").collect()] == ["Ann"]


def test_ties_are_ordered_by_name(worked):
    unique = worked(
        (WEDNESDAY, 60, {"project_name": "b"}),
        (WEDNESDAY, 60, {"project_name": "a"}),
        (WEDNESDAY, 60, {"project_name": None}),
        (WEDNESDAY, 90, {"project_name": "z"}),
    )
    names = [r.project_name for r in daily.top_projects(unique, WEDNESDAY, 3).collect()]
    assert names == ["z", None, "a"]


def test_reports_order_and_agree(worked):
    may, june = date(2024, 5, 2), date(2024, 6, 3)
    unique = worked(
        (may, 60, {"project_name": "a", "assignee_name": "Ann"}),
        (may, 120, {"project_name": "b", "assignee_name": ""}),
        (june, 30, {"project_name": "b", "assignee_name": "Bob"}),
        (june, 45, {"project_name": "a", "assignee_name": None}),
        (june, 15, {"project_name": "a", "assignee_name": "Bob"}),
    )
    effort = reports.monthly_effort(unique)
    for kind in reports.REPORT_KEYS:
        direct = [tuple(r) for r in reports.report(unique, kind).collect()]
        assert [tuple(r) for r in reports.report_from_effort(effort, kind).collect()] == direct
    assert [tuple(r)[:4] for r in reports.report(unique, "project").collect()] == [
        ("2024-06", "a", 2, 1.0),
        ("2024-06", "b", 1, 0.5),
        ("2024-05", "b", 1, 2.0),
        ("2024-05", "a", 1, 1.0),
    ]
    both = reports.report(unique, "project_assignee").collect()
    assert [(r.month, r.project_name, r.assignee_name) for r in both] == [
        ("2024-06", "a", "Bob"),
        ("2024-06", "b", "Bob"),
        ("2024-05", "a", "Ann"),
    ]


@pytest.mark.parametrize(
    "day, ws, we",
    [
        (date(2024, 1, 7), "2024-01-01", "2024-01-07"),
        *[(date(2024, 1, 8 + i), "2024-01-08", "2024-01-14") for i in range(7)],
        (date(2024, 12, 31), "2024-12-30", "2025-01-05"),
    ],
)
def test_week_bounds(spark, day, ws, we):
    days = spark.createDataFrame([(day,)], "day date")
    assert tuple(weekly.week_bounds(days).first()) == (day, ws, we)


@pytest.fixture
def snapshots(spark):
    def build(*rows):
        names = [f.name for f in schema.OPEN_TASKS_SNAPSHOT]
        base = {"snapshot_date": WEDNESDAY, "snapshot_at": datetime(2024, 5, 15), "task_id": "t",
                "project_name": "P", "is_overdue": False}
        full = [tuple({**base, **r}.get(n) for n in names) for r in rows]
        return spark.createDataFrame(full, schema.OPEN_TASKS_SNAPSHOT)

    return build


def test_weekly_plan(snapshots):
    monday = WEDNESDAY - timedelta(days=2)
    snaps = snapshots(
        {"assignee_name": " Ann ", "due_on": monday, "estimated_minutes": 60.0,
         "actual_minutes": 90.0},
        {"assignee_name": "Ann", "due_on": monday + timedelta(days=6),
         "estimated_minutes": 60.0},
        {"assignee_name": "Ann", "due_on": monday + timedelta(days=7),
         "estimated_minutes": 60.0},
        {"assignee_name": "Ann", "due_on": monday - timedelta(days=1), "is_overdue": True,
         "estimated_minutes": 30.0, "actual_minutes": 10.0},
        {"assignee_name": "Ann", "estimated_minutes": 5.0},
        {"assignee_name": "Eve", "due_on": monday, "is_overdue": True},
        {"assignee_name": "", "due_on": monday, "is_overdue": True, "estimated_minutes": 7.0},
        {"assignee_name": None, "due_on": monday, "is_overdue": True},
        {"assignee_name": "Ann", "due_on": monday, "snapshot_date": date(2024, 5, 14)},
    )
    plan = weekly.assignee_plan(snaps, WEDNESDAY, ["Ann", "Ann", "Zoe"])
    assert [tuple(r) for r in plan.collect()] == [("Ann", 2, 60.0, 1, 20.0)]
    with_nobody = weekly.assignee_plan(snaps, WEDNESDAY, ["Ann"], include_unassigned=True)
    assert {r.assignee_name: r.this_week_tasks for r in with_nobody.collect()} == {
        "Ann": 2,
        "(未割当)": 2,
    }
    assert [tuple(r) for r in weekly.project_overdue(snaps, WEDNESDAY).collect()] == [
        ("P", 4, 27.0)
    ]
    names = snaps.sparkSession.createDataFrame([("Ann",), ("Eve",)], "n string")
    overdue = weekly.assignee_overdue(snaps, WEDNESDAY, names).collect()
    assert [tuple(r) for r in overdue] == [("Ann", 1, 20.0), ("Eve", 1, 0.0)]
    unset = weekly.due_unset(snaps, WEDNESDAY, ["Ann", "Eve"]).collect()
    assert [tuple(r) for r in unset] == [("Ann", 1, 5.0)]


def test_open_summary_of_an_empty_day(snapshots):
    snaps = snapshots({"is_overdue": True, "assignee_name": "Ann"}, {"assignee_name": None})
    assert tuple(open_tasks.open_kpi(snaps, WEDNESDAY).first()) == (2, 1)
    assert tuple(open_tasks.open_kpi(snaps, date(2024, 1, 1)).first()) == (0, None)
    top = open_tasks.open_top_assignees(snaps, WEDNESDAY).collect()
    assert [tuple(r) for r in top] == [("Ann", 1)]


def test_task_ids_match_own_and_parent_id_once(spark, completed_rows):
    day = datetime(2024, 5, 1)
    tasks = views.unique_tasks(
        completed_rows(
            {"task_id": "1", "completed_at": day},
            {"task_id": "1a", "parent_task_id": "1", "completed_at": day},
            {"task_id": "2a", "parent_task_id": "2", "completed_at": day},
            {"task_id": "3", "completed_at": day},
        )
    )
    listed = ["1", " 1a ", "2", "", "404"]
    few = {r.task_id for r in audit.of_task_ids(tasks, listed).collect()}
    ids = spark.createDataFrame([(i.strip(),) for i in listed] + [(None,), ("1",)], "id string")
    many = [r.task_id for r in audit.of_task_ids(tasks, ids).collect()]
    assert few == set(many) == {"1", "1a", "2a"} and len(many) == 3
    assert audit.of_task_ids(tasks, [" "]).count() == 4


def test_audit_of_nothing(completed_rows):
    empty = views.unique_tasks(completed_rows({"task_id": "a"}))
    row = audit.effort_total(empty, "P", "Ann").first()
    assert tuple(row) == (0, None, None, "0時間0分", "0時間0分")
    with pytest.raises(ValueError):
        audit.effort_total(empty, "P", "Ann", "2024-05", basis="created")


def test_audit_month_basis(completed_rows):
    tasks = views.unique_tasks(
        completed_rows(
            {"task_id": "a", "project_name": " P ", "assignee_name": "Ann", "actual_time": 1.5,
             "estimated_time": 61.0, "completed_at": datetime(2024, 4, 30, 15),
             "modified_at": datetime(2024, 6, 1)},
        )
    )
    by_completion = audit.effort_total(tasks, "P", "Ann", "2024-05").first()
    assert tuple(by_completion) == (1, 1.5, 61.0, "1時間30分", "1時間1分")
    assert audit.effort_total(tasks, "P", "Ann", "2024-05", "modified").first()[0] == 0
    detail = audit.effort_details(tasks, "P", "Ann", "2024-06", "modified").first()
    assert detail.within_month and detail.completed_month == "2024-05"


def test_dimensions_refresh_and_never_deactivate(spark, completed_rows):
    then, now = datetime(2020, 1, 1), datetime(2024, 6, 1)
    day = datetime(2024, 5, 1)
    tasks = views.unique_tasks(
        completed_rows(
            {"task_id": "a", "completed_at": day, "project_gid": "p1", "project_name": " New ",
             "assignee_gid": "u1", "assignee_name": "Ann "},
            {"task_id": "b", "completed_at": day, "project_gid": "", "assignee_gid": None},
            {"task_id": "c", "completed_at": day, "project_gid": "p3", "project_name": "Three"},
        )
    )
    stored = spark.createDataFrame(
        [("p1", "Old", False, then, then), ("p2", "Two", True, then, then)], schema.DIM_PROJECTS
    )
    rows = {r.project_gid: tuple(r)[1:] for r in dims.upsert_projects(stored, tasks, now).collect()}
    assert rows == {
        "p1": ("New", True, then, now),
        "p2": ("Two", True, then, then),
        "p3": ("Three", True, now, now),
    }
    people = spark.createDataFrame(
        [("u1", "Old", "S1", 7.0, False, then, then)], schema.DIM_USERS
    )
    users = [tuple(r) for r in dims.upsert_users(people, tasks, now).collect()]
    assert users == [("u1", "Ann ", "S1", 7.0, True, then, now)]


def test_run_metrics_count_rows_without_key(spark):
    batch = schema.conform(
        spark.createDataFrame(
            [("a", datetime(2024, 1, 1)), (None, datetime(2024, 1, 1))],
            "task_id string, inserted_at timestamp_ntz",
        ),
        schema.COMPLETED_TASKS,
    )
    start = datetime(2024, 1, 1)
    row = run_metrics(batch, start, start + timedelta(minutes=1)).first()
    assert tuple(row) == (2, 1, start, start + timedelta(minutes=1))
