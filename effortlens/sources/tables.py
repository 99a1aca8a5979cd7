"""Stored tables: plain parquet folders that take merges, and the snapshot table.

A stored table is partitioned by a label (a month, say) and a bucket of its key, so a merge
rewrites only the partitions that hold or receive a row of its batch. What they will hold is
written beside the table first, then their names, and then each takes its place. A job that dies
before the names are written has changed nothing; one that dies later is finished by the next
call, since a partition's new content stays beside the table until it has taken its place. (A
dynamic partition overwrite removes partitions before it renames their new content, with no
record of it, and would have to write the rows a second time.) One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from effortlens import schema
from effortlens.functions.timeutil import iso_millis, local_month
from effortlens.session import freed_shuffles
from effortlens.sources import folders

UNDATED = "none"
BUCKET = "key_bucket"

_LOG = "number long, stamp timestamp_ntz, rows long, rejected long, mark string, labels array<string>"


@dataclass(frozen=True)
class Layout:
    """How a table is laid out: its key, its partitions and the order inside them."""

    schema: T.StructType
    key: tuple[str, ...]
    label: str | None = None
    label_of: Callable[[], Column] | None = None
    cluster_by: tuple[str, ...] = ()
    # What the log keeps of a batch, as text: the latest modification, say.
    mark_of: Callable[[], Column] | None = None

    @property
    def parts(self) -> list[str]:
        return [BUCKET] if self.label is None else [self.label, BUCKET]


def _month_or_undated(month: Column) -> Column:
    return F.coalesce(month, F.lit(UNDATED))


def _last_modified() -> Column:
    return iso_millis(F.max("modified_at"))


COMPLETED_TASKS = Layout(
    schema.COMPLETED_TASKS,
    ("task_id",),
    "completed_month_jst",
    lambda: _month_or_undated(local_month(F.col("completed_at"))),
    ("project_gid", "assignee_gid"),
    _last_modified,
)

TIME_ENTRIES = Layout(
    schema.TIME_ENTRIES,
    ("entry_id",),
    "entered_month",
    lambda: _month_or_undated(F.substring(F.col("entered_on").cast("string"), 1, 7)),
    ("entered_on", "project_name", "user_name"),
    _last_modified,
)

DIM_PROJECTS = Layout(schema.DIM_PROJECTS, ("project_gid",))
DIM_USERS = Layout(schema.DIM_USERS, ("assignee_gid",))

# The newest landed version of every task and subtask.
CURRENT_TASKS = Layout(schema.CURRENT_TASK, ("project_gid", "gid"), cluster_by=("project_gid",))
CURRENT_SUBTASKS = Layout(
    schema.CURRENT_SUBTASK, ("parent_gid", "gid"), cluster_by=("parent_gid",)
)

QUARANTINE = Layout(schema.QUARANTINE, ("source", "line_sha256"), cluster_by=("source",))


@dataclass(frozen=True)
class MergeResult:
    rows: int
    rewritten: tuple[str, ...] = ()  # partitions, as their folders are named
    rejected: int = 0

    @property
    def labels(self) -> tuple[str, ...]:
        """Labels of the rewritten partitions."""
        return tuple(sorted({p.split("/")[0].split("=", 1)[1] for p in self.rewritten}))


class StoredTable:
    """A parquet table with one row per key; ``buckets`` stays what it was at the first merge."""

    def __init__(self, spark: SparkSession, path: str, layout: Layout, buckets: int = 1):
        self.spark = spark
        self.layout = layout
        self.buckets = buckets
        self.path = path.rstrip("/")
        self._log = f"{self.path}/_log"
        self._staging = f"{self.path}/_staging"
        self._pending = f"{self.path}/_pending"
        self._rows = f"{self._pending}/rows"
        self._due = f"{self._pending}/due.json"

    # Reading

    def read(self, labels: Sequence[str] | None = None) -> DataFrame:
        """Rows with their partition label; only the given partitions if named."""
        return self._stored(labels).drop(BUCKET)

    def _stored(self, labels: Sequence[str] | None = None) -> DataFrame:
        kinds = {BUCKET: T.IntegerType()}
        fields = [T.StructField(f.name, f.dataType) for f in self.layout.schema]
        fields += [T.StructField(p, kinds.get(p, T.StringType())) for p in self.layout.parts]
        held = [n for n in folders.names_in(self.spark, self.path) if "=" in n]
        if labels is not None:  # only their folders are listed
            held = sorted(set(held) & {f"{self.layout.label}={label}" for label in labels})
        if not held:
            return _no_rows(self.spark.createDataFrame([], T.StructType(fields)))
        reader = self.spark.read.schema(T.StructType(fields)).option("basePath", self.path)
        return reader.parquet(*([self.path] if labels is None else [f"{self.path}/{n}" for n in held]))

    def labels(self) -> list[str]:
        """Labels of the partitions that hold rows, from the names of folders."""
        named = [n for n in folders.names_in(self.spark, self.path) if n.startswith(f"{self.layout.label}=")]
        return sorted(
            n.split("=", 1)[1]
            for n in named
            if any("=" in b for b in folders.names_in(self.spark, f"{self.path}/{n}"))
        )

    def log(self, after: int = 0) -> DataFrame:
        """One row per merge after the given one: number, stamp, rows, rejected, mark, labels.

        ``stamp`` and ``mark`` are the highest up to this merge.
        """
        later = [n for n in self._logged() if int(n[6:15]) > after]
        if not later:
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).json([f"{self._log}/{n}" for n in later])

    def _logged(self) -> list[str]:
        return [n for n in folders.names_in(self.spark, self._log) if n.startswith("merge-") and n.endswith(".json")]

    def last_logged(self) -> tuple[int, datetime | None, str | None]:
        """Number of the last merge, latest stamp and highest mark; 0 and nulls without any.

        They stand in the last merge's file, so the log's length does not matter.
        """
        newest = max(self._logged(), default=None)
        if newest is None:
            return 0, None, None
        last = json.loads(folders.read_text(self.spark, f"{self._log}/{newest}"))
        stamp = last["stamp"] and datetime.fromisoformat(last["stamp"])
        return last["number"], stamp, last["mark"]

    def high_water(self) -> str | None:
        """Highest mark of all merges, from the log alone; null without any."""
        return self.last_logged()[2]

    # Writing

    def merge(
        self,
        batch: DataFrame,
        combine: Callable[[DataFrame, DataFrame, bool], DataFrame],
        finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        stamp: datetime | None = None,
        mark: str | None = None,
    ) -> MergeResult:
        """Merge a batch of one row per key.

        Rewritten are the partitions that hold an old row of a batch key and those that
        receive a new one; a row that changes its label leaves its old place. The batch is
        written down first, so that its size is known before a join is chosen:
        ``combine(target, batch, small)`` is told whether Spark may broadcast it. ``finish`` is
        applied to every rewritten row. The same batch may be merged again without harm.

        ``combine`` has to treat every key by itself: of a large batch, keys that were stored
        and keys that were not go through it apart, and stored rows that no batch key names
        stay out of it, so that they are shuffled once, to their partitions.
        """
        self.recover()
        folder = f"{self._staging}/{uuid.uuid4().hex}"
        try:
            staged, seen, rejected = self._stage(batch, folder)
            mark = mark or seen["mark"]
            if not seen["rows"]:
                if stamp is not None:
                    self._note({**self._next(stamp, 0, rejected, mark), "labels": []})
                return MergeResult(0, (), rejected)
            stored = self._stored().filter(F.col(BUCKET).isin(*seen["buckets"]))
            small = may_be_sent(self.spark, folder)
            met = self._met(stored, staged, f"{folder}-met", small)
            touched = self._touched(staged, met)
            names = [f.name for f in self.layout.schema]
            target = stored.filter(self._place().isin(*touched)).select(*names)
            fresh = staged.select(*names)
            if small or not may_be_sent(self.spark, f"{folder}-met"):
                merged = combine(target, fresh, small)
            else:
                merged = self._combined_apart(target, fresh, met, combine)
            dealt = self._dealt(finish(merged))
            self._switch(dealt, touched, stamp, seen["rows"], rejected, mark)
            return MergeResult(seen["rows"], tuple(sorted(touched)), rejected)
        finally:
            folders.delete(self.spark, folder)
            folders.delete(self.spark, f"{folder}-met")

    def rewrite(
        self, transform: Callable[[DataFrame], DataFrame] = lambda rows: rows
    ) -> None:
        """Rewrite the whole table in cluster order, with a row-wise change applied.

        Merges have dealt each partition to files of a fair size, so its rows stay with the tasks
        that read these; only partitions of many small files are dealt anew, by a shuffle.
        """
        self.recover()
        files = self._files()
        small = _bytes(self.spark.conf.get("spark.sql.files.openCostInBytes"))
        scattered = [p for p, (number, size) in files.items() if number > 1 and size < number * small]
        self._switch(self._rewritten(transform, scattered), list(files), None, 0, 0, None)

    def _rewritten(self, transform: Callable[[DataFrame], DataFrame], scattered: list[str]) -> DataFrame:
        """All rows after a change, those of scattered partitions dealt anew."""
        names = [f.name for f in self.layout.schema]
        is_scattered = self._place().isin(*scattered)
        rows = self._placed(transform(self._stored().filter(~is_scattered).select(*names)))
        if not scattered:
            return rows
        loose = transform(self._stored().filter(is_scattered).select(*names))
        return rows.unionByName(self._dealt(loose))

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows`` the whole content, and say how many lack a key; they may be read from it."""
        self.recover()
        offered = Observation("offered")
        complete = schema.count_rejected(rows, self.layout.schema, offered)
        self._switch(self._dealt(complete), list(self._files()), None, 0, 0, None)
        return schema.figures_of(offered, rejected=0)["rejected"]

    def recover(self) -> None:
        """Finish a merge that died while its partitions were put in place."""
        due = folders.read_text(self.spark, self._due)
        if due is not None:
            self._put_in_place(json.loads(due))
        folders.delete(self.spark, self._pending)

    def _placed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.layout.key), F.lit(self.buckets)).cast("int")
        if self.layout.label is not None:
            rows = rows.withColumn(self.layout.label, self.layout.label_of())
        return rows.withColumn(BUCKET, bucket)

    def _place(self) -> Column:
        """Name of a row's partition folder."""
        parts = [F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in self.layout.parts]
        return F.concat_ws("/", *parts)

    def _files(self) -> dict[str, tuple[int, int]]:
        """Of each partition with rows how many files it has, and their bytes."""
        stored = self._stored()
        if not stored.inputFiles():
            return {}
        named = stored.select(
            self._place().alias("place"), F.col("_metadata.file_path"), F.col("_metadata.file_size")
        )
        sizes = named.distinct().groupBy("place").agg(F.count("*"), F.sum("file_size"))
        return {place: (number, size) for place, number, size in sizes.collect()}

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with their places, those of a place together, in parts of the advised size."""
        placed = self._placed(rows)
        if self.layout.label is None and self.buckets == 1:  # all rows have one place
            return placed
        return placed.hint("rebalance", *self.layout.parts)

    def _stage(self, batch: DataFrame, folder: str) -> tuple[DataFrame, dict, int]:
        """The batch at rest, figures of it, and rows left out because a required value lacks."""
        counted, offered = Observation("staged"), Observation("offered")
        complete = schema.count_rejected(batch, self.layout.schema, offered)
        mark = self.layout.mark_of() if self.layout.mark_of else F.max(F.lit(None).cast("string"))
        placed = self._placed(complete).observe(
            counted,
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(BUCKET).alias("buckets"),
            mark.alias("mark"),
        )
        with freed_shuffles(placed.sparkSession):
            _dense(placed.write).parquet(folder)
        staged = self.spark.read.schema(placed.schema).parquet(folder)
        seen = schema.figures_of(counted, rows=0, buckets=[], mark=None)
        return staged, seen, schema.figures_of(offered, rejected=0)["rejected"]

    def _met(self, stored: DataFrame, staged: DataFrame, folder: str, small: bool) -> DataFrame | None:
        """Keys of the batch that are stored, with their places, at rest.

        A key without a label has the same place always; those are only asked for where that
        saves a large batch the shuffle of its target.
        """
        if small and self.layout.label is None:
            return None
        key = list(self.layout.key)
        old = stored.select(*key, *self.layout.parts).join(staged.select(*key), key, "left_semi")
        with freed_shuffles(old.sparkSession):
            _dense(old.write).parquet(folder)
        return self.spark.read.schema(old.schema).parquet(folder)

    def _touched(self, staged: DataFrame, met: DataFrame | None) -> list[str]:
        """Partitions of the batch's new rows and of the rows they replace."""
        new = staged.select(self._place().alias("place"))
        if met is not None:
            new = new.unionByName(met.select(self._place().alias("place")))
        return [row[0] for row in new.distinct().collect()]

    def _combined_apart(self, target: DataFrame, batch: DataFrame, met: DataFrame, combine) -> DataFrame:
        """Target after the batch, where the keys that both hold are few."""
        key = list(self.layout.key)
        both = met.select(*key)  # within the threshold, so Spark sends it to every task
        if met.isEmpty():
            return combine(_no_rows(target), batch, False).unionByName(target)
        changed = combine(
            target.join(both, key, "left_semi"),
            batch.join(both, key, "left_semi"),
            False,
        )
        added = combine(_no_rows(target), batch.join(both, key, "left_anti"), False)
        kept = target.join(both, key, "left_anti")
        return changed.unionByName(added).unionByName(kept)

    def _switch(self, rows: DataFrame, touched: list[str], stamp, count, rejected, mark) -> None:
        """Write down what the touched partitions will hold (placed rows), then put it in place."""
        seen = Observation("switched")
        held = F.collect_set(self._place()).alias("places")
        ordered = rows.sortWithinPartitions(*self.layout.parts, *self.layout.cluster_by)
        writer = _dense(ordered.observe(seen, held).write).mode("overwrite")
        with freed_shuffles(rows.sparkSession):
            writer.partitionBy(*self.layout.parts).parquet(self._rows)
        places = sorted(schema.figures_of(seen, places=[])["places"])
        due = {
            **self._next(stamp, count, rejected, mark),
            "filled": places,
            "emptied": sorted(set(touched) - set(places)),
        }
        folders.write_text(self.spark, self._due, json.dumps(due))
        self._put_in_place(due)
        folders.delete(self.spark, self._pending)

    def _put_in_place(self, due: dict) -> None:
        """Move partitions to the table; those that are there already have no copy any more."""
        for place in due["filled"]:
            if folders.exists(self.spark, f"{self._rows}/{place}"):
                folders.put(self.spark, f"{self._rows}/{place}", f"{self.path}/{place}")
        for place in due["emptied"]:
            folders.delete(self.spark, f"{self.path}/{place}")
        labels = {p.split("/")[0].split("=", 1)[1] for p in due["filled"] + due["emptied"]}
        kept = {k: v for k, v in due.items() if k not in ("filled", "emptied")}
        self._note({**kept, "labels": sorted(labels)})

    def _next(self, stamp, count, rejected, mark) -> dict:
        """The log's next entry."""
        number, latest, highest = self.last_logged()
        stamp = max((t for t in (stamp, latest) if t), default=None)
        return {
            "number": number + 1,
            "stamp": stamp and stamp.isoformat(),
            "rows": count,
            "rejected": rejected,
            "mark": max((m for m in (mark, highest) if m), default=None),
        }

    def _note(self, merge: dict) -> None:
        file = f"{self._log}/merge-{merge['number']:09d}.json"
        folders.write_text(self.spark, file, json.dumps(merge) + "\n")


def _no_rows(rows: DataFrame) -> DataFrame:
    """A frame that Spark knows to be empty, so that it leaves out joins with it."""
    return rows.limit(0)


def may_be_sent(spark: SparkSession, folder: str) -> bool:
    """Whether the files of a folder are within Spark's own broadcast threshold."""
    files = spark.read.format("binaryFile").load(folder)
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return size <= _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def _dense(writer: DataFrameWriter) -> DataFrameWriter:
    """What is stored or waits beside a table takes less room so, at little more time."""
    return writer.option("compression", "zstd")


def _bytes(text: str) -> int:
    """A Spark size setting (``10485760b``, ``10MB``, ``-1``) in bytes."""
    units = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    plain = text.strip().lower()
    digits = plain.rstrip("bkmgt")
    return int(digits) * units[plain[len(digits) :][:1]]


def append_snapshot(
    rows: DataFrame, path: str, idempotent: bool = False, day: date | None = None
) -> None:
    """Add a snapshot to the stored history, one folder per day.

    A rerun on the same day adds the rows again unless ``idempotent`` is set, which
    replaces the days present in ``rows``, and ``day`` even if there are none for it any
    more. Nothing is shuffled; the order inside each file lets a scan skip to a project.
    """
    if idempotent and day is not None and rows.isEmpty():
        folders.delete(rows.sparkSession, f"{path.rstrip('/')}/snapshot_date={day}")
    ordered = rows.sortWithinPartitions("snapshot_date", "project_gid", "assignee_gid")
    writer = _dense(ordered.write).partitionBy("snapshot_date")
    if idempotent:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Stored snapshots; files from before the effort columns read as null there."""
    stored = T.StructType(
        [T.StructField(f.name, f.dataType) for f in schema.OPEN_TASKS_SNAPSHOT]
    )
    return spark.read.schema(stored).parquet(path)
