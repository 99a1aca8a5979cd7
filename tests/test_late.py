"""Subtasks that land after their parents, lines that cannot be used, and what is read again."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest

from effortlens.operators import reports
from effortlens.operators.upsert import merge_tasks
from effortlens.operators.views import unique_tasks
from effortlens.plans import effort as totals
from effortlens.plans.current import fold_landing
from effortlens.plans.publish import publish_reports
from effortlens.plans.snapshot import take_snapshot
from effortlens.plans.sync import SyncOptions, sync_completed, sync_time_entries
from effortlens.plans.warehouse import Landing, Warehouse
from effortlens.sources import landing as source
from effortlens.sources.tables import COMPLETED_TASKS, StoredTable, read_snapshots
from effortlens.streaming.incremental import task_upsert_stream
from effortlens.streaming.metrics import read_metrics, stored_metrics


def day(n):
    return f"2024-01-{n:02d}T00:00:00.000Z"


def item(gid, at, done=None, **over):
    return {
        "gid": gid, "name": gid, "completed": done is not None, "completed_at": done,
        "created_at": day(1), "modified_at": at, "due_on": "2024-02-01",
        "assignee": {"gid": "u", "name": "Ann"}, "actual_time_minutes": 60, **over,
    }


def parent(gid, at, done=None, **over):
    row = {"project_gid": "p1", "project_name": "Site", "num_subtasks": 1}
    return {**item(gid, at, done), **row, **over}


def child(gid, of, at, done=None, **over):
    return {**item(gid, at, done), "parent_gid": of, **over}


class Landings:
    """Landing folders that are written day by day, in folders of a day or flat."""

    def __init__(self, root: Path, dated: bool):
        self.root, self.dated, self.files = root, dated, 0
        self.write("projects", 1, [{"gid": "p1", "name": "Site", "modified_at": day(1)},
                                   {"gid": "p2", "name": "Shop", "modified_at": day(1)}])

    def write(self, name, on, rows):
        dated = self.dated and name != "projects"
        folder = self.root / name / (f"landed_on=2024-01-{on:02d}" if dated else ".")
        folder.mkdir(parents=True, exist_ok=True)
        self.files += 1
        lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        (folder / f"part-{self.files:03d}.json").write_text("\n".join(lines))

    @property
    def landing(self):
        return Landing(*(str(self.root / n) for n in ("projects", "tasks")), None, str(self.root / "subtasks"))


def content(table):
    keep = [c for c in table.read().columns if c != "inserted_at"]
    return sorted(map(tuple, table.read().select(keep).collect()), key=str)


def ids(table):
    return sorted(r.task_id for r in table.read().collect())


def streamed(spark, landing, table, root, house):
    task_upsert_stream(
        source.stream_tasks(spark, landing.tasks),
        table,
        str(root / "checkpoint"),
        clock=lambda: datetime(2024, 2, 1),
        listing=lambda: source.read_projects(spark, landing.projects),
        subtasks=source.stream_subtasks(spark, landing.subtasks),
        quarantine=house.quarantine(spark),
    ).start().awaitTermination(300)


@pytest.mark.parametrize("dated", [True, False])
def test_sync_stream_and_full_sync_agree_on_late_subtasks(spark, tmp_path, dated):
    """P lands open; a sync goes by; C of P is completed and lands alone, long after."""
    lands = Landings(tmp_path / "landing", dated)
    lands.write("tasks", 1, [parent("P", day(1)), parent("old", day(1), day(1))])
    lands.write("subtasks", 1, [child("first", "P", day(1), day(1)), child("x", "nobody", day(1), day(1))])
    house, table = Warehouse(str(tmp_path / "house"), 2), StoredTable(
        spark, str(tmp_path / "streamed"), COMPLETED_TASKS
    )
    sync_completed(spark, lands.landing, house, datetime(2024, 1, 2), SyncOptions(full_sync=True))
    streamed(spark, lands.landing, table, tmp_path, house)
    assert ids(house.completed(spark)) == ["first", "old"]

    lands.write("tasks", 15, [parent("Q", day(15), day(15), num_subtasks=0)])
    sync_completed(spark, lands.landing, house, datetime(2024, 1, 16))
    assert ids(house.completed(spark)) == ["Q", "first", "old"]

    lands.write("subtasks", 20, [child("C", "P", day(20), day(20))])
    late = sync_completed(spark, lands.landing, house, datetime(2024, 1, 21))
    assert late.cutoff == datetime(2024, 1, 15) and late.merge.labels == ("2024-01",)
    streamed(spark, lands.landing, table, tmp_path, house)
    assert ids(house.completed(spark)) == ["C", "Q", "first", "old"]

    whole = Warehouse(str(tmp_path / "whole"))
    sync_completed(spark, lands.landing, whole, datetime(2024, 1, 21), SyncOptions(full_sync=True))
    assert content(house.completed(spark)) == content(whole.completed(spark)) == content(table)


def test_parent_that_lands_after_its_subtask(spark, tmp_path):
    """The subtask waits; the parent brings it in, renamed parents and projects too."""
    lands = Landings(tmp_path / "landing", True)
    lands.write("subtasks", 1, [child("C", "P", day(1), day(1)), child("D", "P", day(1))])
    lands.write("tasks", 1, [parent("other", day(1), day(1))])
    house = Warehouse(str(tmp_path / "house"))
    table = StoredTable(spark, str(tmp_path / "streamed"), COMPLETED_TASKS)

    def run(at, **options):
        sync_completed(spark, lands.landing, house, datetime(2024, 1, at), SyncOptions(**options))
        streamed(spark, lands.landing, table, tmp_path, house)

    run(2, full_sync=True)
    assert ids(table) == ids(house.completed(spark)) == ["other"]
    lands.write("tasks", 3, [parent("P", day(3))])
    run(4)
    assert ids(table) == ids(house.completed(spark)) == ["C", "other"]
    # A new version of the parent alone renames its subtasks' project.
    lands.write("tasks", 5, [parent("P", day(5), project_name="Site B")])
    run(6)
    for t in (table, house.completed(spark)):
        assert {r.task_id: r.project_name for r in t.read().collect()}["C"] == "Site B"
    # A version from before arrives late and changes nothing.
    lands.write("subtasks", 7, [child("C", "P", "2023-12-01T00:00:00Z", day(1), name="before")])
    run(8)
    for t in (table, house.completed(spark)):
        assert {r.task_id: r.task_name for r in t.read().collect()}["C"] == "[Subtask] C"


def test_project_that_is_taken_up_again_is_caught_up(spark, tmp_path):
    lands = Landings(tmp_path / "landing", True)
    lands.write("projects", 1, [{"gid": "p3", "name": "Shut", "archived": True, "modified_at": day(1)}])
    lands.write("tasks", 1, [parent("a", day(1), day(1)), parent("P", day(1), project_gid="p3")])
    lands.write("subtasks", 1, [child("C", "P", day(1), day(1))])
    house = Warehouse(str(tmp_path / "house"))
    sync_completed(spark, lands.landing, house, datetime(2024, 1, 2), SyncOptions(full_sync=True))
    assert ids(house.completed(spark)) == ["a"]
    lands.write("projects", 9, [{"gid": "p3", "name": "Shut", "archived": False, "modified_at": day(9)}])
    sync_completed(spark, lands.landing, house, datetime(2024, 1, 10))
    assert ids(house.completed(spark)) == ["C", "a"]


def test_nested_subtask_completed_while_its_parent_stays_as_it_was(spark, tmp_path):
    """The parent's own modification stands still; the subtask inside it moves."""
    lands = Landings(tmp_path / "landing", True)
    lands.write("tasks", 1, [parent("P", day(1), subtasks=[item("C", day(1))]), parent("a", day(1), day(1))])
    landing = Landing(lands.landing.projects, lands.landing.tasks)
    house = Warehouse(str(tmp_path / "house"))
    sync_completed(spark, landing, house, datetime(2024, 1, 2), SyncOptions(full_sync=True))
    lands.write("tasks", 20, [parent("P", day(1), subtasks=[item("C", day(20), day(20))])])
    sync_completed(spark, landing, house, datetime(2024, 1, 21))
    assert ids(house.completed(spark)) == ["C", "a"]


def test_snapshot_reads_one_landing_day_and_the_current_tables(spark, tmp_path, monkeypatch):
    lands = Landings(tmp_path / "landing", True)
    for n in range(1, 10):
        lands.write("tasks", n, [parent(f"t{n}", day(n)), parent("again", day(n), day(n) if n == 9 else None)])
        lands.write("subtasks", n, [child(f"c{n}", f"t{n}", day(n))])
    house = Warehouse(str(tmp_path / "house"))
    take_snapshot(spark, lands.landing, house, datetime(2024, 1, 9, 3))
    lands.write("tasks", 10, [parent("t1", day(10), day(10)), parent("t10", day(10))])
    lands.write("subtasks", 10, [child("c1", "t1", day(10))])
    read = []
    for name in ("read_tasks", "read_subtasks"):
        real = getattr(source, name)
        monkeypatch.setattr(source, name, lambda *a, real=real: read.append(real(*a)) or read[-1])
    take_snapshot(spark, lands.landing, house, datetime(2024, 1, 10, 3), idempotent=True)
    for landed in read:
        plan = landed._jdf.queryExecution().executedPlan().toString()
        assert "landed_on" in plan.split("PartitionFilters: [")[1].split("]")[0]
        days = {r.landed_on for r in landed.select("landed_on").distinct().collect()}
        assert days <= {date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 10)}
    monkeypatch.undo()
    # A fold of all days at once gives the same rows.
    whole = Warehouse(str(tmp_path / "whole"))
    take_snapshot(spark, lands.landing, whole, datetime(2024, 1, 10, 3))
    today = read_snapshots(spark, house.snapshots).filter("snapshot_date = '2024-01-10'")
    got, want = (sorted(map(tuple, rows.collect()), key=str) for rows in (
        today, read_snapshots(spark, whole.snapshots)))
    assert got == want
    assert {r.task_id for r in today.collect()} == {
        *(f"t{n}" for n in range(2, 11)), *(f"c{n}" for n in range(2, 10)),
    }


def test_folding_twice_or_in_parts_is_folding_once(spark, tmp_path):
    lands = Landings(tmp_path / "landing", False)
    lands.write("tasks", 1, [parent("a", day(3), name="new"), parent("b", day(1))])
    houses = [Warehouse(str(tmp_path / n)) for n in ("one", "two")]
    fold_landing(spark, Landing("", str(tmp_path / "landing" / "tasks")), houses[0], datetime(2024, 1, 1))
    lands.write("tasks", 1, [parent("a", day(2), name="old"), parent("b", day(4), name="new"), parent("c", day(1))])
    landing = Landing("", str(tmp_path / "landing" / "tasks"))
    results = []
    for house in houses:
        for at in (2, 3):
            now = fold_landing(spark, landing, house, datetime(2024, 1, at))
        results.append({r.gid: (r.name, r.seen_at) for r in now.tasks.collect()})
    assert {k: v[0] for k, v in results[0].items()} == {"a": "new", "b": "new", "c": "c"}
    assert {k: v[0] for k, v in results[0].items()} == {k: v[0] for k, v in results[1].items()}
    # Seen by the first fold, changed by the second, and left alone by the third.
    assert {k: v[1].day for k, v in results[0].items()} == {"a": 1, "b": 2, "c": 2}


def test_one_broken_line_per_landing_is_set_aside_and_counted(spark, tmp_path):
    lands = Landings(tmp_path / "landing", False)
    lands.write("projects", 1, ['{"gid": "p9"'])
    lands.write("tasks", 1, [parent("a", day(1), day(1)), '{"gid": \n'.strip(), parent(None, day(1)),
                             parent(None, day(1)), parent(None, day(2))])
    lands.write("subtasks", 1, [child("c", "a", day(1), day(1)), "not json"])
    entries = tmp_path / "entries"
    entries.mkdir()
    entry = {"gid": "e", "entered_on": "2024-01-01", "duration_minutes": 5}
    (entries / "part.json").write_text(json.dumps(entry) + "\n{broken\n")
    landing = lands.landing
    landing = Landing(landing.projects, landing.tasks, str(entries), landing.subtasks)
    house = Warehouse(str(tmp_path / "house"))
    run = datetime(2024, 1, 1, 20)
    outcome = sync_completed(spark, landing, house, run, SyncOptions(full_sync=True))
    assert (outcome.tasks_processed, outcome.errors) == (2, 6)
    merged = sync_time_entries(spark, landing, house, run)
    assert (merged.rows, merged.rejected) == (1, 1)
    rows = house.quarantine(spark).read().collect()
    assert sorted((r.source, r.reason, r.copies) for r in rows) == [
        ("projects", "not readable", 1),
        ("subtasks", "not readable", 1),
        ("tasks", "no key", 1),
        ("tasks", "no key", 2),
        ("tasks", "not readable", 1),
        ("time_entries", "not readable", 1),
    ]
    assert {r.line for r in rows} >= {"not json", "{broken", '{"gid": "p9"'}
    # The stream sets the same lines aside, so nothing is added.
    table = StoredTable(spark, str(tmp_path / "streamed"), COMPLETED_TASKS)
    other = Warehouse(str(tmp_path / "other"))
    streamed(spark, landing, table, tmp_path, other)
    found = {(r.source, r.line_sha256) for r in other.quarantine(spark).read().collect()}
    known = {(r.source, r.line_sha256) for r in rows if r.source in ("tasks", "subtasks")}
    assert len(found) == len(known) and ids(table) == ["a", "c"]
    taken = take_snapshot(spark, landing, house, run)
    assert (taken.malformed, taken.rejected) == (3, 3)
    assert house.quarantine(spark).read().count() == 6


def test_reports_read_only_months_that_merges_have_touched(spark, tmp_path, completed_rows, monkeypatch):
    house = Warehouse(str(tmp_path / "house"), 2)
    table = house.completed(spark)

    def merge(*rows):
        full = [{"project_name": "P", "assignee_name": "Ann", "actual_minutes": 60.0, **r} for r in rows]
        table.merge(completed_rows(*full), merge_tasks)

    def on(month):
        return datetime(2024, month, 10)

    merge(*({"task_id": f"t{m}{k}", "completed_at": on(m)} for m in (1, 2, 3, 4) for k in (1, 2)))
    assert totals.refresh_effort(spark, house) == [f"2024-0{m}" for m in (1, 2, 3, 4)]
    assert totals.refresh_effort(spark, house) == []
    untouched = {f for f in totals.stored_effort(spark, house).inputFiles() if "2024-02" not in f}
    merge({"task_id": "t21", "completed_at": on(2), "actual_minutes": 600.0})
    months, _ = totals.stale_months(spark, house)
    assert months == ["2024-02"]
    plan = totals.month_totals(spark, house, months)
    assert all("completed_month_jst=2024-02" in f for f in plan.inputFiles())
    assert totals.refresh_effort(spark, house) == ["2024-02"]
    assert untouched <= set(totals.stored_effort(spark, house).inputFiles())

    def same_as_all():
        unique = unique_tasks(table.read(), one_row_per_task=True)
        for kind in reports.REPORT_KEYS:
            stored = reports.report_from_effort(totals.stored_effort(spark, house), kind)
            assert stored.collect() == reports.report(unique, kind).collect()

    same_as_all()
    # A task changes month; another month loses its last tasks.
    merge({"task_id": "t11", "completed_at": on(3)},
          {"task_id": "t41", "completed_at": None}, {"task_id": "t42", "completed_at": None})
    assert totals.refresh_effort(spark, house) == ["2024-01", "2024-03", "2024-04"]
    same_as_all()
    assert "2024-04" not in {r.month for r in totals.stored_effort(spark, house).collect()}
    # A refresh that dies before it is noted is done again.
    merge({"task_id": "t22", "completed_at": on(1)})
    merge({"task_id": "t21", "completed_at": on(5)})
    monkeypatch.setattr(totals.folders, "delete", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        totals.refresh_effort(spark, house)  # February has lost its last task
    monkeypatch.undo()
    assert totals.refresh_effort(spark, house) == ["2024-01", "2024-02", "2024-05"]
    same_as_all()
    assert publish_reports(spark, house, datetime(2024, 5, 1)) == dict.fromkeys(reports.REPORT_KEYS, True)


def test_every_micro_batch_has_a_row_of_figures_restarts_included(spark, tmp_path):
    lands = Landings(tmp_path / "landing", False)
    lands.write("tasks", 1, [parent("a", day(1), day(1)), "broken", parent("P", day(1))])
    lands.write("subtasks", 1, [child("x", "nobody", day(1), day(1))])
    house, landing = Warehouse(str(tmp_path / "house")), lands.landing
    table = house.completed(spark)
    fail = {"now": False}

    def clock():
        if fail["now"]:
            raise OSError("the cluster went away")
        return datetime(2024, 2, 1)

    def run(figures):
        query = task_upsert_stream(
            source.stream_tasks(spark, landing.tasks), table, str(tmp_path / "checkpoint"), clock=clock,
            subtasks=source.stream_subtasks(spark, landing.subtasks),
        ).start()
        try:
            query.awaitTermination(300)
        finally:
            figures.wait_for(str(query.runId), 60)

    with stored_metrics(spark, house.stream_metrics) as figures:
        run(figures)
        lands.write("subtasks", 2, [child("C", "P", day(2), day(2)), child(None, "P", day(2))])
        fail["now"] = True
        with pytest.raises(Exception, match="went away"):
            run(figures)
        fail["now"] = False
        run(figures)
        run(figures)  # nothing has landed
    rows = sorted(read_metrics(spark, house.stream_metrics).collect(), key=lambda r: r.batch_id)
    assert [(r.batch_id, r.tasks_processed, r.errors, r.refused) for r in rows] == [(0, 1, 0, 1), (1, 1, 0, 1)]
    assert len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 2
    assert ids(table) == ["C", "a"]


def test_the_stream_keeps_no_rows_in_its_state(spark, tmp_path):
    """Both sides of the late join stand packed below the checkpoint, none in a state store."""
    lands = Landings(tmp_path / "landing", False)
    lands.write("tasks", 1, [parent("P", day(1))])
    lands.write("subtasks", 1, [child("C", "P", day(1), day(1)), child("D", "Q", day(1), day(1))])
    table = StoredTable(spark, str(tmp_path / "streamed"), COMPLETED_TASKS)
    house = Warehouse(str(tmp_path / "house"))
    streamed(spark, lands.landing, table, tmp_path, house)
    assert ids(table) == ["C"]
    lands.write("tasks", 2, [parent("Q", day(2))])
    lands.write("subtasks", 2, [child("E", "P", day(2), day(2))])
    streamed(spark, lands.landing, table, tmp_path, house)
    assert ids(table) == ["C", "D", "E"]
    assert not (tmp_path / "checkpoint/state").exists()
    assert sorted(f.name for f in (tmp_path / "checkpoint/arrived").iterdir()) == ["batch=0", "batch=1"]
