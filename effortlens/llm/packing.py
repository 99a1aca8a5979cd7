"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are counted in blank-separated tokens. A document longer than the largest sequence is
cut into full pieces and a rest. Pieces are dealt by a hash of their row number and piece, so
that each group holds about ``group_pieces`` whatever ids or lengths repeat, and every group
is packed in one task that holds only numbers:

* pieces in descending length go to the open bin with the least room that still holds them;
* where none does, a bin is opened of the size that is cheapest per token once filled greedily
  with what is left (all permitted sizes are tried together);
* at the end each bin shrinks to the smallest permitted size that holds its contents.

Defined results: a null, empty or blank text has no tokens and gets one row without a bin;
repeated rows are packed as documents of their own; null ids stay null; an empty table gives
an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from effortlens.llm.storage import written

CAPACITIES = (256, 512, 1024, 2048)
GROUP_PIECES = 20_000

_SCHEMA = (
    "doc_id long, piece int, start long, n_tokens int, bin_id long, bin_offset int, capacity int"
)


def best_fit(lengths, capacities, costs=None) -> tuple[list[int], list[int], list[int]]:
    """Bin number and offset of every length (given in descending order); size of every bin."""
    sizes = sorted(capacities)
    costs = dict(zip(sizes, costs or sizes, strict=True))
    falling = [-int(x) for x in lengths]
    room: list[tuple[int, int]] = []  # (room, bin) of open bins, ascending
    used: list[int] = []
    opened: list[int] = []
    bins, offsets = [], []

    def fill(size: int, at: int) -> int:
        """Tokens that a new bin of this size takes from the lengths from ``at`` on."""
        free, i = size, at
        while free and i < len(falling):
            i = max(i, bisect_left(falling, -free, i))
            if i < len(falling):
                free += falling[i]
                i += 1
        return size - free

    for at, negative in enumerate(falling):
        need = -negative
        i = bisect_left(room, (need, -1))
        if i < len(room):
            left, b = room.pop(i)
        else:
            fits = [s for s in sizes if s >= need]
            left = min(fits, key=lambda s: (costs[s] / fill(s, at), s))
            b = len(used)
            used.append(0)
            opened.append(left)
        bins.append(b)
        offsets.append(used[b])
        used[b] += need
        if left > need:
            insort(room, (left - need, b))
    return bins, offsets, [next(s for s in sizes if s >= u) for u in used]


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacities: tuple[int, ...] = CAPACITIES,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: its bin, place in the bin and the bin's size."""
    most = max(capacities)
    sizes = written(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).alias("tokens"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "token-counts",
    )
    n_pieces = F.ceil(F.col("tokens") / most).cast("int")
    total = sizes.agg(F.sum(n_pieces)).first()[0] or 0
    groups = max(1, -(-total // group_pieces))
    pieces = (
        sizes.filter("tokens > 0")
        .select("doc_id", "row_no", "tokens", F.explode(F.sequence(F.lit(0), n_pieces - 1)).alias("piece"))
        .select(
            "doc_id",
            "row_no",
            "piece",
            F.least(F.lit(most), F.col("tokens") - F.col("piece") * most).alias("n_tokens"),
            F.pmod(F.xxhash64("row_no", "piece"), F.lit(groups)).alias("pack"),
        )
    )

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "row_no", "piece"], ascending=[False, True, True])
        bins, offsets, ends = best_fit(rows["n_tokens"].tolist(), capacities)
        bins = np.asarray(bins)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].array,
                "piece": rows["piece"].array,
                "start": rows["piece"].to_numpy().astype("int64") * most,
                "n_tokens": rows["n_tokens"].array,
                "bin_id": (int(key[0]) << 32) + bins.astype("int64"),
                "bin_offset": offsets,
                "capacity": np.asarray(ends)[bins],
            }
        )

    # Ids may be null, which a pandas integer column would turn into floats.
    packed = (
        pieces.withColumn("doc_id", F.col("doc_id").cast("string"))
        .groupBy("pack")
        .applyInPandas(run, _SCHEMA.replace("doc_id long", "doc_id string"))
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
    none = sizes.filter("tokens = 0").select(
        "doc_id",
        F.lit(0).alias("piece"),
        F.lit(0).cast("long").alias("start"),
        F.lit(0).alias("n_tokens"),
        *[F.lit(None).cast(t).alias(c) for c, t in
          (("bin_id", "long"), ("bin_offset", "int"), ("capacity", "int"))],
    )
    return packed.unionByName(none)


def sequences(docs: DataFrame, packed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts of the bins: the pieces' tokens in place order, joined by blanks.

    A bin is bounded by its capacity, so is what is gathered for it.
    """
    words = docs.select(F.col(doc_id).alias("doc_id"), F.split(F.trim(text), r"\s+").alias("words"))
    placed = packed.filter("bin_id is not null").join(words, "doc_id")
    piece = F.slice("words", (F.col("start") + 1).cast("int"), F.col("n_tokens"))
    return (
        placed.select("bin_id", "capacity", "bin_offset", "doc_id", F.array_join(piece, " ").alias("t"))
        .groupBy("bin_id", "capacity")
        .agg(F.array_sort(F.collect_list(F.struct("bin_offset", "doc_id", "t"))).alias("parts"))
        .select(
            "bin_id",
            "capacity",
            F.col("parts.doc_id").alias("doc_ids"),
            F.array_join("parts.t", " ").alias("text"),
        )
    )
