"""New task payloads merged into the completed-task table as they land."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from effortlens import schema
from effortlens.functions.timeutil import ntz_literal
from effortlens.operators import metrics, normalize, projects, scans, upsert
from effortlens.session import checkpoint_folder, freed_shuffles
from effortlens.sources import folders
from effortlens.sources.landing import MALFORMED
from effortlens.sources.quarantine import refusal, refused_lines, set_aside
from effortlens.sources.tables import StoredTable

OBSERVED = "sync"

# Each takes the figures of micro-batches, by the query's id and the batch's number.
WATCHERS: list[dict[tuple[str, int], dict[str, int]]] = []


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _marked(landed: DataFrame, source: str, keys: tuple[str, ...]) -> DataFrame:
    """Landed rows with their source; of those that cannot be used the line and why."""
    if MALFORMED not in landed.columns:
        landed = landed.withColumn(MALFORMED, F.lit(None).cast("string"))
    payload = F.to_json(F.struct(*[c for c in landed.columns if c != MALFORMED]))
    marked = landed.withColumns({"source": F.lit(source), "refused_for": refusal(keys)})
    line = F.when(F.col("refused_for").isNotNull(), F.coalesce(MALFORMED, payload))
    return marked.withColumn(MALFORMED, line)


def _arrived(spark: SparkSession, folder: str, kinds: T.StructType, batches: list[int]) -> DataFrame | None:
    """What given micro-batches brought; none without any."""
    if not batches:
        return None
    return spark.read.schema(kinds).parquet(*[f"{folder}/batch={n}" for n in batches])


def streamed_items(
    tasks: DataFrame, subtasks: DataFrame, old_tasks: DataFrame | None, old_subtasks: DataFrame | None
) -> DataFrame:
    """Items of the tasks that arrive, and of every parent and subtask that now meet.

    Tasks and subtasks are facts of payloads, so that joins carry nothing else.
    A parent that arrives meets all subtasks so far, a subtask that arrives all parents before
    it, so each pair of versions comes once, however far apart they land. ``parent_instant``
    tells versions of a parent apart.
    """
    instant = F.col("modified_at").alias("parent_instant")

    def children(parents: DataFrame, apart: DataFrame) -> DataFrame:
        announced = parents.filter(F.col("num_subtasks") > 0).select(
            "project_gid", "project_name", F.col("gid").alias("parent_gid"), instant
        )
        return normalize.child_items(announced, apart, also=("parent_instant",))

    own = normalize.own_items(tasks).withColumn("parent_instant", F.lit(None).cast("timestamp_ntz"))
    known = subtasks if old_subtasks is None else subtasks.unionByName(old_subtasks)
    items = own.unionByName(children(tasks, known))
    return items if old_tasks is None else items.unionByName(children(old_tasks, subtasks))


def bare_facts(payloads: DataFrame, is_subtask: bool, include_incomplete_subtasks: bool) -> DataFrame:
    """Facts of payloads; of those that no table will hold only what versions are told by.

    They count, since the newest version of a task may be one that is open again.
    """
    read = normalize.facts(payloads).withColumn("is_subtask", F.lit(is_subtask))
    is_done = F.coalesce(normalize.is_completed_row(include_incomplete_subtasks), F.lit(False))
    told_by = ("gid", "parent_gid", "project_gid", "project_name", "num_subtasks",
               "completed", "completed_at", "modified_at")
    names = [c for c in read.columns if c != "is_subtask"]
    return read.select(*[c if c in told_by else F.when(is_done, F.col(c)).alias(c) for c in names])


def _newest_pairs(rows: DataFrame) -> DataFrame:
    """Of each task and project the newest version, with the newest version of its parent."""
    order = [F.col("modified_at").desc_nulls_last(), F.col("parent_instant").desc_nulls_last()]
    newest = F.row_number().over(Window.partitionBy("task_id", "project_gid").orderBy(*order))
    ranked = rows.withColumn("pair_rank", newest).filter("pair_rank = 1")
    return ranked.drop("pair_rank", "parent_instant")


def task_upsert_stream(
    tasks: DataFrame,
    table: StoredTable,
    checkpoint: str | None = None,
    include_incomplete_subtasks: bool = False,
    clock: Callable[[], datetime] = _utc_now,
    listing: Callable[[], DataFrame] | None = None,
    project_filter: str | None = None,
    subtasks: DataFrame | None = None,
    quarantine: StoredTable | None = None,
) -> DataStreamWriter:
    """Writer that merges each micro-batch of the task stream; the caller starts it.

    ``listing`` reads the landed projects anew for each micro-batch, which then keeps the rows
    of active, matching projects only, as the batch sync does. ``subtasks`` is the stream of
    detached subtasks. Lines that cannot be used go to ``quarantine``.

    The checkpoint takes the place of a modification watermark; it defaults to a folder
    of the table's own below the one the cluster names for checkpoints. A micro-batch that is
    replayed after a failure merges the same rows again, which changes nothing; stored rows of
    a later modification stay. With ``subtasks``, what each micro-batch brought is kept below the
    checkpoint, packed by columns, for those it will meet later: nothing is held in memory
    between micro-batches. Figures of every micro-batch are told to ``WATCHERS``, see
    ``streaming.metrics``.
    """
    landing = _marked(tasks, "tasks", ("project_gid", "gid"))
    if subtasks is not None:
        apart = _marked(subtasks, "subtasks", ("parent_gid", "gid"))
        landing = landing.unionByName(apart, allowMissingColumns=True)
    is_done = F.coalesce(normalize.is_completed_row(include_incomplete_subtasks), F.lit(False))
    own = hashlib.sha256(table.path.encode()).hexdigest()[:16]
    folder = checkpoint or checkpoint_folder(table.spark, f"task-upsert-{own}")
    kept = f"{folder.rstrip('/')}/arrived"

    def merge(landed: DataFrame, batch_id: int) -> None:
        spark = landed.sparkSession
        place = f"{kept}/batch={batch_id}"
        try:
            # Parsed once; a replay writes the same rows again.
            with freed_shuffles(spark):
                landed.write.mode("overwrite").option("compression", "zstd").parquet(place)
            parsed = _arrived(spark, kept, landed.schema, [batch_id])
            usable = F.col("refused_for").isNull()
            refused = parsed.filter(~usable)

            def of(rows: DataFrame | None, source: str, like: DataFrame) -> DataFrame | None:
                if rows is None:
                    return None
                names = [c for c in like.columns if c != MALFORMED]
                return rows.filter(usable & (F.col("source") == source)).select(*names)

            def bare(rows: DataFrame | None, source: str, like: DataFrame) -> DataFrame | None:
                found = of(rows, source, like)
                if found is None:
                    return None
                return bare_facts(found, source == "subtasks", include_incomplete_subtasks)

            if subtasks is None:
                items = normalize.task_items(of(parsed, "tasks", tasks))
                items = items.withColumn("parent_instant", F.lit(None).cast("timestamp_ntz"))
            else:
                numbers = [int(n[6:]) for n in folders.names_in(spark, kept) if n.startswith("batch=")]
                before = _arrived(spark, kept, landed.schema, [n for n in numbers if n < batch_id])
                # Spark leaves out the join with what is known to be empty.
                fresh = [bare(parsed, "tasks", tasks), bare(parsed, "subtasks", subtasks)]
                items = streamed_items(
                    *[rows.limit(0) if rows.isEmpty() else rows for rows in fresh],
                    bare(before, "tasks", tasks),
                    bare(before, "subtasks", subtasks),
                )
            made_from = normalize.task_facts(items, "parent_instant", "completed")
            seen = Observation(OBSERVED)
            arrived = made_from.observe(seen, *metrics.figures(["task_id"], is_done))
            if listing is not None:
                known = projects.active_projects(scans.latest_payloads(listing(), "gid"))
                chosen = projects.named_like(known, project_filter)
                arrived = projects.of_projects(arrived, chosen)
            now = clock()
            # What is newest is told before what is completed, as in the batch sync.
            done = _newest_pairs(arrived).filter(is_done).withColumn("inserted_at", ntz_literal(now))
            newest = upsert.latest_in_batch(done)
            table.merge(
                upsert.stage_batch(normalize.task_rows(newest), now),
                lambda stored, new, small: upsert.merge_tasks(stored, new, small, keep_newer=True),
                finish=upsert.backfill_minutes,
                stamp=now,
            )
            if quarantine is not None:
                for source in ("tasks", "subtasks"):
                    lines = refused.filter(F.col("source") == source).select(MALFORMED, "refused_for")
                    set_aside(refused_lines(lines, source, now), quarantine)
            if WATCHERS:
                figures = schema.figures_of(seen, tasks_processed=0, errors=0)
                query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
                for watcher in WATCHERS:
                    watcher[query, batch_id] = {**figures, "refused": refused.count()}
        finally:
            if subtasks is None:
                folders.delete(spark, place)

    return (
        landing.writeStream.foreachBatch(merge)
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
    )
