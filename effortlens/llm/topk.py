"""Exact top-k by inner product with dual cover trees.

Vectors are first sent to the nearest of a few pivots: the top level of the tree, chosen by
farthest-first traversal from a bounded sample (``SAMPLE`` rows by hash of the id). Every row
is indexed under its pivot. Data rows make blocks of about ``BLOCK_ROWS`` and queries groups
of about ``QUERY_ROWS``: small pivots share one, large ones are split by hash, so a pivot
that holds most of the rows is spread like any other.

Each (group, block) pair is searched in one task that builds a cover tree on either side. A
node's children are chosen farthest-first, so they lie at least as far apart as the radius
they cover. A pair of nodes is skipped where

    <q, r> + R_q |r| + R_r |q| + R_q R_r

(centres q, r, covering radii R) is below the worst k-th score of the queries in the query
node. The first pass searches each group's home block; the second searches the other blocks,
those excepted that the same bound over the pivots rules out against the group's worst k-th
score so far. At most k rows per query and block meet in the final ranking.

Defined results: vectors that are null or hold null or non-finite components, and rows
without id, take no part; shorter vectors count as padded with zeros; ties go to the smaller
id; each row is a candidate of its own, also when repeated, but never for a query of its own
id; an id that several query rows share is asked once, with the least vector; an empty table
gives an empty result; where the width times the square of the largest whole component reaches
2**63, so that a score might pass a long, the search stops with an error. Other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from effortlens.llm.storage import written

SAMPLE = 4096
PIVOTS = 32
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
FANOUT = 16
LEAF = 64

_FOUND = "query_id long, vec_id long, score long"
_SLACK = 1e-6


def stacked(vectors, width: int | None = None) -> np.ndarray:
    """Rows of one width, padded with zeros; floats where products are exact in them."""
    width = width or max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = max(1, np.abs(a).max(initial=0)) * max(1, np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return (a.astype(float), b.astype(float)) if float(top) < 2.0**53 else (a, b)


def farthest_first(x: np.ndarray, count: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres, and for each row the place of its nearest centre and the distance to it."""
    centres, nearest = [0], np.zeros(len(x), np.int64)
    far = np.linalg.norm(x - x[0], axis=1)
    while len(centres) < count and far.max() > 0:
        centres.append(int(far.argmax()))
        d = np.linalg.norm(x - x[centres[-1]], axis=1)
        closer = d < far
        nearest[closer] = len(centres) - 1
        far[closer] = d[closer]
    return centres, nearest, far


class CoverTree:
    """A node: rows ``at`` around ``centre``, none farther than ``radius``."""

    def __init__(self, x: np.ndarray, at: np.ndarray, centre: np.ndarray, radius: float):
        self.at, self.centre, self.radius = at, centre, radius
        self.norm = float(np.linalg.norm(centre))
        self.children: list[CoverTree] = []
        if len(at) > LEAF and radius > 0:
            centres, nearest, far = farthest_first(x[at], FANOUT)
            for i, c in enumerate(centres):
                mine = nearest == i
                self.children.append(
                    CoverTree(x, at[mine], x[at[c]], float(far[mine].max(initial=0)))
                )

    @classmethod
    def over(cls, x: np.ndarray) -> CoverTree:
        return cls(x, np.arange(len(x)), x[0], float(np.linalg.norm(x - x[0], axis=1).max()))


def bound(q, r) -> float:
    """No inner product between the two nodes is greater."""
    top = float(q.centre @ r.centre) + q.radius * r.norm + r.radius * q.norm + q.radius * r.radius
    return top + _SLACK * (1 + abs(top))


class Search:
    """Best ``k`` data rows of each query, kept while node pairs are visited."""

    def __init__(self, queries, query_ids, data, data_ids, k: int, floor: np.ndarray):
        self.q_int, self.d_int = _exact(queries, data)
        self.query_ids, self.data_ids, self.k = query_ids, data_ids, k
        self.score = np.full((len(queries), k), np.iinfo(np.int64).min, np.int64)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
        self.floor = floor.astype(np.float64)  # the k-th score so far
        self.q, self.d = queries.astype(float), data.astype(float)

    def run(self) -> None:
        stack = [(CoverTree.over(self.q), CoverTree.over(self.d))]
        while stack:
            q, r = stack.pop()
            if bound(q, r) < self.floor[q.at].min():
                continue
            if not q.children and not r.children:
                self._compare(q.at, r.at)
            elif r.children and (not q.children or r.radius >= q.radius):
                # The most promising child is on top.
                stack += sorted(((q, c) for c in r.children), key=lambda p: bound(*p))
            else:
                stack += [(c, r) for c in q.children]

    def _compare(self, q: np.ndarray, d: np.ndarray) -> None:
        scores = self.q_int[q] @ self.d_int[d].T
        usable = (scores >= self.floor[q][:, None]) & (
            self.query_ids[q][:, None] != self.data_ids[d][None, :]
        )
        some = usable.any(1)
        if not some.any():
            return
        q, usable = q[some], usable[some]
        fresh = np.where(usable, scores[some].astype(np.int64), np.iinfo(np.int64).min)
        ids = np.where(usable, self.data_ids[d][None, :], np.iinfo(np.int64).max)
        score = np.concatenate([self.score[q], fresh], axis=1)
        found = np.concatenate([self.found[q], ids], axis=1)
        # Complemented scores rise where scores fall, without overflow at the least long.
        order = np.lexsort((found, ~score), axis=-1)[:, : self.k]
        self.score[q] = np.take_along_axis(score, order, 1)
        self.found[q] = np.take_along_axis(found, order, 1)
        full = self.found[q][:, -1] < np.iinfo(np.int64).max
        worst = self.score[q][:, -1].astype(np.float64)
        self.floor[q[full]] = np.maximum(self.floor[q[full]], worst[full])

    def rows(self) -> pd.DataFrame:
        there = self.found < np.iinfo(np.int64).max
        return pd.DataFrame(
            {
                "query_id": np.repeat(self.query_ids, self.k).reshape(-1, self.k)[there],
                "vec_id": self.found[there],
                "score": self.score[there],
            }
        )


def _allot(counts: list[int], size: int) -> tuple[list[int], list[int]]:
    """First block and number of blocks of each pivot; small neighbours share a block."""
    first, parts, block, filled = [], [], 0, 0
    for n in counts:
        if filled and filled + n > size:
            block, filled = block + 1, 0
        first.append(block)
        parts.append(max(1, -(-n // size)))
        if n > size:
            block, filled = block + parts[-1], 0
        else:
            filled += n
    return first, parts


def _dealt(cluster: Column, first: list[int], parts: list[int], salt: Column) -> Column:
    start = F.get(F.array(*[F.lit(x) for x in first]), cluster)
    count = F.get(F.array(*[F.lit(x) for x in parts]), cluster)
    return (start + F.pmod(salt, count)).cast("int")


class _Ball:
    def __init__(self, centre: np.ndarray, radius: float):
        self.centre, self.radius, self.norm = centre, radius, float(np.linalg.norm(centre))


def whole_numbers(vector: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of every component, or null where the vector takes no part."""
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return F.when(fine, scaled)


def _search_pairs(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int, width: int):
    """Search all (grp, block) ``pairs``; queries carry the k-th score so far as ``floor``."""

    def search(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        d = d.sort_values("vec_id")
        found = Search(
            stacked(q["v"].tolist(), width),
            q["vec_id"].to_numpy(),
            stacked(d["v"].tolist(), width),
            d["vec_id"].to_numpy(),
            k,
            q["floor"].fillna(-np.inf).to_numpy(float),
        )
        found.run()
        return found.rows()

    left = queries.join(pairs, "grp").select("grp", "block", "vec_id", "v", "floor")
    right = data.join(pairs, "block").select("grp", "block", "vec_id", "v")
    return left.groupBy("grp", "block").cogroup(right.groupBy("grp", "block")).applyInPandas(search, _FOUND)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best other rows of each query row.

    ``is_query`` is a condition over ``vec_id``; ``vector`` holds numbers, scaled and floored
    by ``whole_numbers``.
    """
    spark = vectors.sparkSession
    named = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vector)).alias("v")
    ).filter("vec_id is not null and v is not null")
    sample = named.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).select("v").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    x = stacked([r["v"] for r in sample]).astype(float)
    pivots = x[farthest_first(x, PIVOTS)[0]] if x.shape[1] else x[:1]

    @F.arrow_udf("struct<cluster: int, far: double, width: int>")
    def nearest(batch: pa.Array) -> pa.Array:
        rows = stacked(batch.to_pylist()).astype(float)
        width = max(rows.shape[1], pivots.shape[1])
        a = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
        b = np.pad(pivots, ((0, 0), (0, width - pivots.shape[1])))
        cluster = ((b * b).sum(1)[None, :] - 2 * a @ b.T).argmin(1) if len(a) else np.zeros(0, int)
        far = np.linalg.norm(a - b[cluster], axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(far), pa.array([width] * len(a), pa.int32())],
            ["cluster", "far", "width"],
        )

    placed = named.select("vec_id", "v", nearest("v").alias("p"))
    placed = written(placed.select("vec_id", "v", "p.cluster", "p.far", "p.width"), "placed-vectors")
    asked = placed.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "cluster", "far")).alias("q"))
    asked = written(asked.select("vec_id", "q.v", "q.cluster", "q.far"), "queries")

    def by_pivot(rows: DataFrame) -> tuple[list[int], list[float]]:
        got = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
        sizes, radii = [0] * len(pivots), [0.0] * len(pivots)
        for r in got:  # one row per pivot
            sizes[r["cluster"]], radii[r["cluster"]] = r["n"], r["far"]
        return sizes, radii

    largest = F.greatest(F.array_max("v").cast("double"), -F.array_min("v").cast("double"))
    width, top = placed.agg(F.max("width"), F.max(largest)).first()
    if top is not None and width * top * top >= 2.0**63:
        raise OverflowError("a component is too large to be scored in whole numbers")
    centres = np.pad(pivots, ((0, 0), (0, width - pivots.shape[1])))
    data_sizes, data_radii = by_pivot(placed)
    query_sizes, query_radii = by_pivot(asked)
    data_lot = _allot(data_sizes, block_rows)
    query_lot = _allot(query_sizes, query_rows)
    salt = F.xxhash64("vec_id")
    data = placed.select(
        "vec_id", "v", _dealt(F.col("cluster"), *data_lot, F.xxhash64("vec_id", "v")).alias("block")
    )
    grouped = asked.select("vec_id", "v", "cluster", _dealt(F.col("cluster"), *query_lot, salt).alias("grp"))

    home = F.get(F.array(*[F.lit(b) for b in data_lot[0]]), F.col("cluster"))
    groups = grouped.groupBy("grp").agg(
        F.array_sort(F.collect_set("cluster")).alias("clusters"), F.mode(home, True).alias("home")
    )  # at most one entry per pivot
    first = written(groups.select("grp", F.col("home").alias("block")), "first-pairs")
    no_floor = F.lit(None).cast("double").alias("floor")
    near = written(
        _search_pairs(first, grouped.select("grp", "vec_id", "v", no_floor), data, k, width), "home-hits"
    )

    floors = near.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor")
    )
    ready = written(
        grouped.join(floors, grouped["vec_id"] == floors["query_id"], "left").select(
            "grp", "cluster", "vec_id", "v", "floor"
        ),
        "queries-after-home",
    )
    worst = ready.groupBy("grp", "cluster").agg(
        F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("worst")
    )
    q_balls = [_Ball(c, r) for c, r in zip(centres, query_radii, strict=True)]
    d_balls = [_Ball(c, r) for c, r in zip(centres, data_radii, strict=True)]
    # The bound between pivots, where there are rows: PIVOTS squared numbers.
    tops = [
        [bound(q, d) if n else float("-inf") for d, n in zip(d_balls, data_sizes, strict=True)]
        for q in q_balls
    ]
    lots = [[data_lot[0][j], data_lot[0][j] + data_lot[1][j] - 1] for j in range(len(pivots))]
    table = F.array(*[F.array(*[F.lit(t) for t in row]) for row in tops])
    spans = F.array(*[F.array(*[F.lit(t) for t in row]) for row in lots])
    others = (
        worst.select("grp", "worst", F.posexplode(F.get(table, F.col("cluster"))).alias("pivot", "top"))
        .filter("top >= worst and top > double('-inf')")
        .select("grp", F.get(spans, F.col("pivot")).alias("s"))
        .select("grp", F.explode(F.sequence(F.col("s")[0], F.col("s")[1])).alias("block"))
        .distinct()
        .join(first, ["grp", "block"], "left_anti")
    )
    rest = written(others, "other-pairs")
    far = _search_pairs(rest, ready.select("grp", "vec_id", "v", "floor"), data, k, width)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
