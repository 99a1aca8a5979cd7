"""Landed payloads to flat rows."""

from datetime import date, datetime

import pytest

from effortlens.operators import normalize, projects, scans
from effortlens.sources import landing as source


def task(gid, **over):
    base = {
        "project_gid": "p1",
        "project_name": "P one",
        "gid": gid,
        "name": f"task {gid}",
        "completed": False,
        "created_at": "2024-01-01T00:00:00.000Z",
        "modified_at": "2024-01-02T00:00:00.000Z",
        "due_on": "2024-01-09",
        "assignee": {"gid": "u1", "name": "Ann"},
        "num_subtasks": 0,
        "custom_fields": [],
    }
    return {**base, **over}


DONE = {"completed": True, "completed_at": "2024-01-31T15:00:00.000Z"}


def sub(gid, **over):
    return {k: v for k, v in task(gid, **over).items() if not k.startswith("project_")}


@pytest.fixture
def payloads():
    return [
        task(
            "1",
            num_subtasks=3,
            subtasks=[
                sub("1a", **DONE, actual_time_minutes=0,
                    custom_fields=[{"name": "実績", "number_value": 90}]),
                sub("1b", assignee=None, due_on="someday"),
                sub("1c", completed=True, completed_at=None),
            ],
        ),
        task("2", **DONE, num_subtasks=0, subtasks=[sub("2a", **DONE)], assignee=None,
             custom_fields=[{"name": "Estimate", "text_value": "2h"},
                            {"name": "工数", "text_value": "", "display_value": "30"}]),
        task("3", completed=True, completed_at=None),
        task("4", **DONE, num_subtasks=1, subtasks=[sub("4a")]),
    ]


def split(payloads):
    """The same payloads with subtasks landed apart."""
    parents = [{k: v for k, v in p.items() if k != "subtasks"} for p in payloads]
    children = [
        {**s, "parent_gid": p["gid"]} for p in payloads for s in p.get("subtasks", [])
    ]
    return parents, children


@pytest.fixture(params=["inside", "apart"])
def items(request, spark, land, payloads):
    def build(select=lambda tasks: tasks):
        if request.param == "inside":
            tasks = source.read_tasks(spark, land("tasks", payloads))
            return normalize.task_items(select(tasks))
        parents, children = split(payloads)
        tasks = source.read_tasks(spark, land("tasks", parents))
        apart = source.read_subtasks(spark, land("subtasks", children))
        return normalize.task_items(select(tasks), apart)

    return build


def by_id(df):
    rows = df.collect()
    result = {r.task_id: r for r in rows}
    assert len(result) == len(rows)
    return result


def test_completed_parents_and_subtasks(items):
    rows = by_id(normalize.completed_task_rows(items()))
    # 2a is not announced by its parent; 1c and 3 have no completion instant.
    assert set(rows) == {"1a", "2", "4"}
    a = rows["1a"]
    assert a.task_name == "[Subtask] task 1a" and a.parent_task_id == "1" and a.is_subtask
    assert (a.project_id, a.project_gid, a.project_name) == ("p1", "p1", "P one")
    assert (a.actual_minutes, a.actual_time, a.actual_time_raw) == (0.0, 0.0, 0.0)
    assert a.completed_at == datetime(2024, 1, 31, 15)
    two = rows["2"]
    assert two.assignee_name is None and two.assignee_gid is None
    assert two.parent_task_id is None and not two.is_subtask
    assert (two.estimated_time, two.estimated_minutes) == (120.0, 120.0)
    assert (two.actual_time, two.actual_time_raw) == (0.5, 30.0)
    assert two.due_on == date(2024, 1, 9)


def test_incomplete_subtasks_on_request(items):
    rows = by_id(normalize.completed_task_rows(items(), include_incomplete_subtasks=True))
    assert set(rows) == {"1a", "1b", "1c", "2", "4", "4a"}
    assert rows["1b"].completed_at is None and rows["1b"].due_on is None


def test_open_rows_come_from_open_parents(items):
    rows = by_id(normalize.open_task_rows(items(scans.still_open)))
    assert set(rows) == {"1", "1b"}
    assert rows["1b"].task_name == "[Subtask] task 1b" and rows["1b"].assignee_name is None
    assert not rows["1"].has_time_fields


def test_overdue_is_strictly_before_the_day(spark, items):
    opened = normalize.open_task_rows(items(scans.still_open))
    taken = datetime(2024, 1, 9, 7)
    on_due_day = by_id(normalize.snapshot_rows(opened, date(2024, 1, 9), taken))
    day_after = by_id(normalize.snapshot_rows(opened, date(2024, 1, 10), taken))
    assert not on_due_day["1"].is_overdue and day_after["1"].is_overdue
    assert day_after["1b"].is_overdue is False
    assert day_after["1"].snapshot_date == date(2024, 1, 10)
    assert day_after["1"].snapshot_at == taken


def test_completed_since(spark, land):
    tasks = source.read_tasks(
        spark,
        land(
            "tasks",
            [
                task("old", completed=True, completed_at="2023-12-31T23:59:59.999Z"),
                task("edge", completed=True, completed_at="2024-01-01T00:00:00.000Z"),
                task("open"),
                task("unknown", completed=None),
                task("edited", completed=True, completed_at="2022-01-01T00:00:00.000Z",
                     modified_at="2024-05-01T00:00:00.000Z"),
            ],
        ),
    )
    kept = {r.gid for r in scans.completed_since(tasks, datetime(2024, 1, 1)).collect()}
    assert kept == {"edge", "open", "unknown"}
    modified = scans.completed_since(tasks, datetime(2024, 1, 1), by="modified")
    assert {r.gid for r in modified.collect()} == {"old", "edge", "open", "unknown", "edited"}
    with pytest.raises(ValueError):
        scans.completed_since(tasks, datetime(2024, 1, 1), by="created")


def test_cutoff_precedence():
    mark, given = datetime(2024, 5, 1), datetime(2024, 4, 1)
    cutoff = scans.completed_since_cutoff
    assert cutoff() == datetime(2023, 1, 1)
    assert cutoff(override=given) == given
    assert cutoff(watermark=mark, override=given) == mark
    assert cutoff(watermark=mark, override=given, backfill=True) == given
    assert cutoff(watermark=mark, backfill=True) == datetime(1970, 1, 1)
    assert cutoff(watermark=mark, full_sync=True) == datetime(1970, 1, 1)
    assert cutoff(watermark=mark, override=given, full_sync=True) == given


def test_projects(spark, land):
    listed = source.read_projects(
        spark,
        land(
            "projects",
            [
                {"gid": "1", "name": "Alpha", "archived": False},
                {"gid": "2", "name": "alphabet", "archived": True},
                {"gid": "3", "name": "The Alpha", "created_at": "2024-01-01T00:00:00Z"},
                {"gid": "4", "name": "alpha"},
            ],
        ),
    )
    active = projects.active_projects(listed)
    assert {r.gid for r in active.collect()} == {"1", "3", "4"}
    assert {r.gid for r in projects.named_like(active, "Alpha").collect()} == {"1", "3"}
    assert projects.named_like(active, None).count() == 3
    states = {r.project_gid: r.archive_state for r in projects.project_directory(listed).collect()}
    assert states == {"1": "アクティブ", "2": "アーカイブ済み", "3": None, "4": None}


def test_time_entries(spark, land):
    entries = source.read_time_entries(
        spark,
        land(
            "entries",
            [
                {"gid": "e1", "entered_on": "2024-01-05", "duration_minutes": 30,
                 "created_at": "2024-01-05T01:00:00Z", "task": {"gid": "t", "name": "T"},
                 "user": {"gid": "u", "name": "Ann"},
                 "attributed_project": {"gid": "p", "name": "P"}},
                {"gid": "e2", "entered_on": "2024-01-06", "duration_minutes": None},
                {"gid": "e3", "entered_on": "2024-01-08", "duration_minutes": 5},
                {"gid": "e4", "entered_on": None, "duration_minutes": 5},
            ],
        ),
    )
    chosen = scans.entries_between(entries, date(2024, 1, 5), date(2024, 1, 7))
    rows = {r.entry_id: r for r in normalize.time_entry_rows(chosen).collect()}
    assert set(rows) == {"e1", "e2"}
    assert (rows["e1"].task_id, rows["e1"].project_id, rows["e1"].user_name) == ("t", "p", "Ann")
    assert rows["e2"].task_id is None and rows["e2"].user_name is None
    of_user = scans.entries_between(entries, date(2024, 1, 1), date(2024, 1, 31), user_gid="u")
    assert [r.gid for r in of_user.collect()] == ["e1"]
    assert scans.yesterday(datetime(2024, 1, 5, 15)) == date(2024, 1, 5)
    assert scans.yesterday(datetime(2024, 1, 5, 14)) == date(2024, 1, 4)


def test_watermark(spark, completed_rows):
    stored = completed_rows(
        {"task_id": "a", "modified_at": datetime(2024, 1, 2, 3, 4, 5, 678900)},
        {"task_id": "b", "modified_at": datetime(2023, 1, 1)},
        {"task_id": "c"},
    )
    assert scans.sync_watermark(stored).first()[0] == "2024-01-02T03:04:05.678Z"
    assert scans.sync_watermark(stored.limit(0)).first()[0] is None
