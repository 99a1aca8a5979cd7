"""Merging a batch into stored rows, with either join."""

from datetime import datetime

import pytest

from effortlens.operators import upsert

JAN, FEB = datetime(2024, 1, 10), datetime(2024, 2, 10)


@pytest.fixture(params=[False, True], ids=["full", "small"])
def merge(request):
    def run(target, batch):
        rows = upsert.merge_tasks(target, batch, request.param).collect()
        return {r.task_id: r for r in rows}, len(rows)

    return run


def test_overwrites_inserts_and_leaves(completed_rows, merge):
    target = completed_rows(
        {"task_id": "a", "task_name": "old", "completed_at": JAN},
        {"task_id": "b", "task_name": "same", "completed_at": JAN},
    )
    batch = completed_rows(
        {"task_id": "a", "task_name": "new", "completed_at": FEB},
        {"task_id": "c", "task_name": "added", "completed_at": FEB},
    )
    rows, count = merge(target, batch)
    assert count == 3
    assert {k: v.task_name for k, v in rows.items()} == {"a": "new", "b": "same", "c": "added"}
    assert rows["a"].completed_at == FEB


def test_absent_values_keep_only_the_four_columns(completed_rows, merge):
    target = completed_rows(
        {
            "task_id": "a",
            "project_gid": "p1",
            "assignee_gid": "u1",
            "estimated_minutes": 10.0,
            "actual_minutes": 20.0,
            "project_name": "P",
            "estimated_time": 10.0,
            "due_on": None,
            "completed_at": JAN,
        }
    )
    rows, _ = merge(target, completed_rows({"task_id": "a", "is_subtask": None}))
    row = rows["a"]
    assert (row.project_gid, row.assignee_gid) == ("p1", "u1")
    assert (row.estimated_minutes, row.actual_minutes) == (10.0, 20.0)
    assert row.project_name is None and row.estimated_time is None
    assert row.completed_at is None and row.is_subtask is None


def test_older_batch_still_wins(completed_rows, merge):
    target = completed_rows({"task_id": "a", "task_name": "new", "modified_at": FEB})
    rows, _ = merge(target, completed_rows({"task_id": "a", "task_name": "x", "modified_at": JAN}))
    assert rows["a"].task_name == "x" and rows["a"].modified_at == JAN


def test_merging_twice_changes_nothing(completed_rows, merge):
    target = completed_rows({"task_id": "a", "task_name": "t"}, {"task_id": "b"})
    batch = completed_rows({"task_id": "b", "task_name": "n"}, {"task_id": "c"})
    once = upsert.merge_tasks(target, batch)
    rows, count = merge(once, batch)
    assert count == 3
    assert sorted(map(tuple, rows.values())) == sorted(map(tuple, once.collect()))


def test_batch_keeps_the_latest_of_each_task(completed_rows):
    batch = completed_rows(
        {"task_id": "a", "task_name": "old", "modified_at": JAN},
        {"task_id": "a", "task_name": "new", "modified_at": FEB},
        {"task_id": "b", "task_name": "z", "project_gid": "p2", "modified_at": JAN},
        {"task_id": "b", "task_name": "y", "project_gid": "p1", "modified_at": JAN},
        # No modification instant: the insertion instant stands in.
        {"task_id": "c", "task_name": "stamped", "inserted_at": FEB},
        {"task_id": "c", "task_name": "modified", "modified_at": JAN, "inserted_at": FEB},
    )
    names = {r.task_id: r.task_name for r in upsert.latest_in_batch(batch).collect()}
    assert names == {"a": "new", "b": "y", "c": "stamped"}


def test_minutes_are_filled_in_order(completed_rows):
    tasks = completed_rows(
        {"task_id": "a", "estimated_time": 5.0, "actual_time_raw": 6.0, "actual_time": 9.0},
        {"task_id": "b", "actual_time": 2.0},
        {"task_id": "c", "estimated_minutes": 0.0, "estimated_time": 5.0, "actual_minutes": 0.0,
         "actual_time_raw": 1.0},
        {"task_id": "d"},
    )
    filled = {
        r.task_id: (r.estimated_minutes, r.actual_minutes)
        for r in upsert.backfill_minutes(tasks).collect()
    }
    assert filled == {"a": (5.0, 6.0), "b": (None, 120.0), "c": (0.0, 0.0), "d": (None, None)}


def test_entries_are_replaced_once_each(spark):
    rows = spark.createDataFrame(
        [("e1", 30.0, JAN), ("e1", 45.0, FEB), ("e2", None, JAN)],
        "entry_id string, duration_minutes double, modified_at timestamp_ntz",
    )
    batch = upsert.stage_entries(rows, FEB)
    old = upsert.stage_entries(
        spark.createDataFrame(
            [("e2", 5.0, JAN), ("e3", 90.0, JAN)],
            "entry_id string, duration_minutes double, modified_at timestamp_ntz",
        ),
        JAN,
    )
    result = {
        r.entry_id: (r.duration_minutes, r.duration_hours, r.inserted_at)
        for r in upsert.replace_entries(old, batch).collect()
    }
    assert result == {
        "e1": (45.0, 0.75, FEB),
        "e2": (None, 0.0, FEB),
        "e3": (90.0, 1.5, JAN),
    }
