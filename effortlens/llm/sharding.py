"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters records uniformly into buckets that fit a task's memory: a record's shard
is the rendezvous winner of seeded hashes of its key (one more shard takes rows only into
itself), and its bucket inside the shard comes from a second seeded hash of the whole record,
so that records that share a key still spread. The number of buckets follows the measured
bytes of each shard; ``bucket_bytes`` is what a task may hold, and since each bucket is a
shuffle partition, large inputs want it large (100 TB at 512 MiB make 200,000 buckets). Pass two gathers one bucket per partition, orders it by hash so that a
re-run task starts from the same order, applies a seeded Fisher-Yates shuffle (Spark's
``shuffle`` on the bucket's array) and numbers the records; a bucket's first slot is the
running count of the buckets before it.

Defined results: a null key hashes like any other value; a null text counts no bytes; fully
equal records share a bucket and each gets its own slot; an empty table gives an empty
result; columns of the input named like an added column (``shard``, ``slot``,
``grown_shard``) are replaced by it. Columns must be hashable (no maps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from effortlens.llm.storage import written

SEED = 20240607
BUCKET_BYTES = 16 << 20


def rendezvous(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash with the key is greatest."""
    bids = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("h"), F.lit(s).alias("s"))
            for s in range(shards)]
    return F.greatest(*bids)["s"] if shards > 1 else F.lit(0)


def record_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard_records(
    df: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> DataFrame:
    """All records with ``shard``, ``slot`` (gapless from 0 in a shard) and ``grown_shard``."""
    placed = df.select(
        F.struct("*").alias("record"),
        rendezvous(F.col(f"`{key}`"), shards, seed).alias("shard"),
        record_bytes(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.lit(seed + 1), *[F.col(f"`{c}`") for c in df.columns]).alias("draw"),
    )
    sizes = {
        r["shard"]: r["size"]
        for r in placed.groupBy("shard").agg(F.sum("size").alias("size")).collect()
    }
    # At most ``shards`` rows come back; each shard's buckets follow those of the one before.
    first, total = [], 0
    for s in range(shards):
        first.append((total, max(1, -(-sizes.get(s, 0) // bucket_bytes))))
        total += first[-1][1]
    starts = F.array(*[F.lit(a) for a, _ in first])
    widths = F.array(*[F.lit(n) for _, n in first])
    bucket = F.get(starts, F.col("shard")) + F.pmod(F.col("draw"), F.get(widths, F.col("shard")))
    scattered = placed.withColumn("bucket", bucket.cast("int"))
    counts = scattered.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")),
        "bucket-offsets",
    )
    gathered = (
        scattered.repartitionById(total, F.col("bucket"))
        .sortWithinPartitions("bucket", "draw")
        .groupBy("bucket")
        .agg(F.collect_list(F.struct("shard", "record")).alias("rows"))
    )
    shuffled = gathered.select(
        "bucket", F.posexplode(F.shuffle("rows", seed=seed)).alias("place", "row")
    )
    kept = [c for c in df.columns if c not in ("shard", "slot", "grown_shard")]
    return shuffled.join(offsets, "bucket").select(
        *[F.col("row.record")[c].alias(c) for c in kept],
        F.col("row.shard").alias("shard"),
        (F.col("offset") + F.col("place")).alias("slot"),
        rendezvous(F.col("row.record")[key], shards + 1, seed).alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, records in slot order inside every file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
