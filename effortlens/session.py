"""Session settings for runs of any size."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that let Spark size and split the work itself. Adaptive execution merges small
# shuffle partitions but never makes more of them, so a session for large inputs names
# their size and starts from a number to match.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # A long-lived session runs more distinct plans than the default cache of 100 holds;
    # evicted code is compiled and warmed up again on its next use.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Call-site capture costs several JVM round trips per expression built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}

# Spark removes shuffle files when the driver's garbage collector finds their plan unused, which on
# an idle driver heap is half an hour later: a run of many writes then holds those of all of them.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, tuple[int, str | None]] = {}  # by session: writes under way, setting before
_guard = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each action inside are removed as it ends.

    For plans that run once, as a write's does. Sessions may write from several threads.
    """
    session = spark._jsparkSession.sessionUUID()
    with _guard:
        writes, before = _freeing.get(session) or (0, spark.conf.get(_FREED, None))
        _freeing[session] = (writes + 1, before)
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _guard:
            writes, before = _freeing.pop(session)
            if writes > 1:
                _freeing[session] = (writes - 1, before)
            elif before is None:
                spark.conf.unset(_FREED)
            else:
                spark.conf.set(_FREED, before)


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle partitions: about one per target size, at least one per core."""
    return max(cores, -(-input_bytes // target_bytes))


def build_session(
    app_name: str = "effortlens",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 1,
    **settings: str,
) -> SparkSession:
    """A session; with ``input_bytes`` its shuffles start wide enough for that much input."""
    builder = SparkSession.builder.appName(app_name)
    if input_bytes is not None:
        number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        settings = {number: str(shuffle_partitions(input_bytes, cores)), **settings}
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A job's own folder below the checkpoint folder that the cluster names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set; pass a checkpoint folder")
    return f"{shared.rstrip('/')}/{name}"
