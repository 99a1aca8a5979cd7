"""Hard negatives by one-bit codes of rotated vectors.

Vectors are whole numbers, floor(256 x) of every component. A vector x of d dimensions is turned
by ``ROTATIONS`` seeded rotations, and only the signs s of the results are kept: its code. With
Q the stacked rotations, scaled so that Q'Q = I, the code stands for g = Q's, and x is split
into a part along g and the rest,

    x = t g + r,  r orthogonal to g,  t = <x, g> / <g, g>,

of which t (the alignment with the code vector), |r| and <g, g> are stored beside the code. An
anchor a is turned likewise and rounded to ``PLANES`` bits per turned component, so that
<a, g> = <Qa, s> comes from popcounts of the code and each bit plane, at most e off, where e is
the sum of what the rounding took away. By Cauchy and Schwarz

    |<a, x> - t <a, g>| <= |r| sqrt(|a|^2 - <a, g>^2 / <g, g>),

so every inner product has an interval that it cannot leave. Rows whose interval cannot reach
the results are passed over; the others are scored in whole numbers, so results are exact.

Rows are indexed once and dealt into blocks of about ``BLOCK_ROWS`` by row number, whatever
labels or vectors repeat. In either pass (positives, then negatives between 0.8 times a
positive's score and that score) each row is shuffled once and the stated anchors are sent to
every block; a task holds one block and a few anchors. At most ``k`` rows per block, anchor and
positive meet in a ranking.

Defined results: rows with a null id or label, a null vector, or a null or non-finite component
take no part; shorter vectors count as padded with zeros; ties go to the smaller id; each row is
a candidate of its own, also when repeated, but never for an anchor of its own id; an id that
several anchor rows share is asked once, with the least (label, vector); an anchor without a
positive, and a positive without a negative, give no row; an empty table gives an empty result.
Components whose whole number would pass 2**52, and products beyond a long, stop the job with an
error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from effortlens.llm.storage import written
from effortlens.llm.whitening import usable

SCALE = 256.0
ROTATIONS = 16
PLANES = 6
BLOCK_ROWS = 65_536
SEED = 20_240_603

_LIMIT = 2.0**52
_PROBES = 32
_SLACK = 1e-9
_STEP = 4096
_ROW = "block int, vec_id long, label int, v array<long>"
_INDEX = f"{_ROW}, code binary, align double, rest double, gg double"
_POSITIVES = "array<struct<vec_id: long, score: long>>"


def rotations(width: int, count: int = ROTATIONS, seed: int = SEED) -> np.ndarray:
    """``count`` random rotations above each other, scaled so that the columns have norm 1."""
    draw = np.random.default_rng(seed)
    turns = [np.linalg.qr(draw.standard_normal((width, width)))[0] for _ in range(count)]
    return np.concatenate(turns) / np.sqrt(count) if width else np.zeros((0, 0))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    words = -(-max(bits.shape[1], 1) // 64)
    full = np.zeros((len(bits), words * 64), np.uint8)
    full[:, : bits.shape[1]] = bits
    return np.packbits(full, axis=1).view(np.uint64)


def encode(x: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the rows of ``x``, alignments, norms of the rests, and <g, g>."""
    x = x.astype(np.float64)
    bits = x @ turned.T > 0
    g = np.where(bits, 1.0, -1.0) @ turned
    gg = (g * g).sum(1)
    align = np.divide((x * g).sum(1), gg, out=np.zeros(len(x)), where=gg > 0)
    rest = np.linalg.norm(x - align[:, None] * g, axis=1)
    return _packed(bits), align, rest, gg


def inner(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; an error where one is beyond a long."""
    top = int(np.abs(x).max(initial=0)) * int(np.abs(a).max(initial=0)) * max(1, x.shape[1])
    if top < 1 << 53:
        return (x.astype(np.float64) @ a.astype(np.float64)).astype(np.int64)
    if top < 1 << 63:
        return x @ a
    exact = x.astype(object) @ a.astype(object)
    if len(exact) and max(abs(int(p)) for p in exact) >= 1 << 63:
        raise OverflowError("an inner product is beyond a long")
    return exact.astype(np.int64)


@dataclass
class Block:
    """Indexed rows that are searched together, ordered by label."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    codes: np.ndarray  # one row of words per 64 bits, one column per vector
    align: np.ndarray
    rest: np.ndarray
    gg: np.ndarray
    turned: np.ndarray

    def __post_init__(self):
        self.ones = np.bitwise_count(self.codes).sum(0, dtype=np.int64)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))

    def intervals(
        self, a: np.ndarray, part: slice = slice(None)
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Estimated inner products of ``part`` with ``a``, and bounds that they cannot pass."""
        align, rest, gg, ones = (x[part] for x in (self.align, self.rest, self.gg, self.ones))
        a = a.astype(np.float64)
        turned = self.turned @ a
        low = float(turned.min(initial=0.0))
        step = (float(turned.max(initial=0.0)) - low) / (2**PLANES - 1) or 1.0
        level = np.rint((turned - low) / step).astype(np.int64)
        rounded = low + step * level
        off = np.abs(turned - rounded).sum()
        counts = np.zeros(len(align), np.int64)
        for plane in range(PLANES):
            words = _packed((level >> plane & 1)[None, :].astype(np.uint8))[0]
            hits = np.zeros(len(align), np.int32)
            for code, word in zip(self.codes, words, strict=True):
                hits += np.bitwise_count(code[part] & word)
            counts += hits.astype(np.int64) << plane
        along = 2 * (low * ones + step * counts) - rounded.sum()
        sure = np.maximum(np.abs(along) - off, 0.0)
        norm = float(a @ a)
        across = norm - np.divide(sure**2, gg, out=np.zeros(len(sure)), where=gg > 0)
        estimate = align * along
        half = np.abs(align) * off + np.sqrt(np.maximum(across, 0.0)) * rest
        # What rounding of doubles could hide is far below this.
        length = np.abs(align) * np.sqrt(gg) + rest
        half += _SLACK * (1 + length * np.sqrt(norm))
        return estimate, estimate - half, estimate + half

    def best(self, a, at, estimate, high, k, least=None, most=None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of the rows ``at`` and their scores, from ``least`` to ``most``.

        ``estimate`` and ``high`` are of the same rows. A few rows with high estimates are scored
        first; rows whose upper bound is below the worst of ``k`` of these are passed over.
        """

        def scored(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            scores = inner(self.x[rows], a)
            fits = np.ones(len(rows), bool)
            if most is not None:
                fits = (scores >= least) & (scores <= most)
            return rows[fits], scores[fits]

        if len(at) > _PROBES:
            near = estimate if most is None else np.where(estimate <= most, estimate, -np.inf)
            _, probed = scored(at[np.argpartition(near, -_PROBES)[-_PROBES:]])
            if len(probed) >= k:
                at = at[high >= float(np.sort(probed)[-k])]
        rows, scores = scored(at)
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[order], scores[order]


def whole_rows(vectors: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    named = vectors.select(
        vec_id.cast("long").alias("vec_id"), label.cast("int").alias("label"), vector.alias("vector")
    )
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return named.filter(known & usable(F.col("vector")))


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    out = np.zeros((len(column), width), kind)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def build_index(rows: DataFrame, width: int, blocks: int) -> DataFrame:
    """Rows with their whole numbers, code, alignment, norm of the rest and <g, g>."""
    turned = rotations(width)
    salted = rows.select(
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"),
        "vec_id",
        "label",
        "vector",
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                c = _matrix(batch.column(3), width, np.float64)
                if np.abs(c).max(initial=0.0) * SCALE >= _LIMIT:
                    raise ValueError("a component is too large to be scored in whole numbers")
                x = np.floor(SCALE * c).astype(np.int64)
                codes, align, rest, gg = encode(x, turned)
                ends = np.arange(len(x) + 1) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:3],
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.ravel())),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(align),
                        pa.array(rest),
                        pa.array(gg),
                    ],
                    ["block", "vec_id", "label", "v", "code", "align", "rest", "gg"],
                )

    return salted.mapInArrow(index, _INDEX)


def _in_blocks(index: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Each block's rows, and after them all anchors, in one partition and in this order."""
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "label", "v", "positives"
    )
    rows = index.select("*", F.lit(None).cast(_POSITIVES).alias("positives"), F.lit(0).alias("kind"))
    both = rows.unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")


def _searched(rows: DataFrame, width: int, search, result: str) -> DataFrame:
    """``search(block, anchors)`` for each block and a few anchors at a time.

    ``anchors`` are (vec_id, label, vector, positives); rows of ``result`` come back.
    """
    turned = rotations(width)
    names = [part.split()[0] for part in result.split(", ")]

    def block_of(parts: list[pa.RecordBatch]) -> Block:
        held = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        raw = b"".join(held.column("code").to_pylist())
        codes = np.frombuffer(raw, np.uint64).reshape(held.num_rows, -1)
        x = _matrix(held.column("v"), width, np.int64)
        numbers = ("vec_id", "label", "align", "rest", "gg")
        labels = held.column("label").to_numpy()
        order = np.argsort(labels, kind="stable")
        ids, labels, align, rest, gg = (held.column(c).to_numpy()[order] for c in numbers)
        codes = np.ascontiguousarray(codes[order].T)
        return Block(ids, labels, x[order], codes, align, rest, gg, turned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, block = None, [], None
        for whole in batches:
            keys = whole.column("block").to_numpy()
            kinds = whole.column("kind").to_numpy()
            edge = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for at, to in zip([0, *edge], [*edge, len(keys)], strict=True):
                if at == to:
                    continue
                batch = whole.slice(at, to - at)
                if keys[at] != number:
                    number, parts, block = keys[at], [], None
                if kinds[at] == 0:
                    parts.append(batch)
                    continue
                if not parts and block is None:
                    continue  # a block that no row was dealt to
                if block is None:
                    block, parts = block_of(parts), []
                v = _matrix(batch.column("v"), width, np.int64)
                asked = zip(
                    batch.column("vec_id").to_pylist(),
                    batch.column("label").to_pylist(),
                    v,
                    batch.column("positives").to_pylist(),
                    strict=True,
                )
                found = [row for anchor in asked for row in search(block, *anchor)]
                if found:
                    columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, result)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    vec_id: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition over ``vec_id``; ``label`` an expression over the input. An
    anchor's positives are its best ``positives`` rows of the same label; for each come the best
    ``negatives`` rows of other labels whose score is at most the positive's and at least 0.8
    times it.
    """
    spark = vectors.sparkSession
    label = F.col("label") if label is None else label
    rows = whole_rows(vectors, F.col(vec_id), label, F.col(vector))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    # Blocks of the stated size; small tables are spread over the cores, with equal results.
    blocks = max(1, -(-n // block_rows), min(spark.sparkContext.defaultParallelism, n // 4096))
    index = written(build_index(rows, width, blocks), "code-index")
    first = F.min(F.struct("label", "v")).alias("a")
    asked = index.filter(is_anchor).groupBy("vec_id").agg(first).select("vec_id", "a.label", "a.v")
    asked = written(asked, "anchors")

    def same_label(block: Block, anchor: int, label: int, a: np.ndarray, _):
        part = block.of_label(label)
        estimate, _, high = block.intervals(a, part)
        others = np.flatnonzero(block.ids[part] != anchor)
        found = block.best(a, part.start + others, estimate[others], high[others], positives)
        for row, score in zip(*found, strict=True):
            yield anchor, int(block.ids[row]), int(score)

    def other_labels(block: Block, anchor: int, label: int, a: np.ndarray, wanted):
        estimate, low, high = block.intervals(a)
        others = block.labels != label
        for slot, positive in enumerate(wanted):
            most = positive["score"]
            least = -(-80 * most // 100)  # 80 * most <= 100 * score, in whole numbers
            at = np.flatnonzero(others & (low <= float(most)) & (high >= float(least)))
            found = block.best(a, at, estimate[at], high[at], negatives, least, most)
            for row, score in zip(*found, strict=True):
                yield anchor, slot, positive["vec_id"], most, int(block.ids[row]), int(score)

    unknown = F.lit(None).cast(_POSITIVES).alias("positives")
    near = _searched(
        _in_blocks(index, asked.select("*", unknown), blocks),
        width,
        same_label,
        "anchor_id long, vec_id long, score long",
    )
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    # At most ``positives`` entries each.
    lists = ranked.groupBy("anchor_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))),
            lambda p: F.struct(p["vec_id"].alias("vec_id"), p["score"].alias("score")),
        ).alias("positives")
    )
    known = asked.join(lists, asked["vec_id"] == lists["anchor_id"]).drop("anchor_id")
    known = written(known, "anchors-with-positives")
    far = _searched(
        _in_blocks(index, known, blocks),
        width,
        other_labels,
        "anchor_id long, slot long, positive_id long, positive_score long, "
        "negative_id long, negative_score long",
    )
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("negative_score").desc(), "negative_id")
    best = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return best.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
