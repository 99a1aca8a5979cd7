"""Whitening of embeddings with covariances by polarisation.

An entry c counts as the whole number x = floor(64 c) + 1000000. No product of two different
dimensions is ever formed: the exact squares of the centred values are added up for every
dimension and for the sum of every pair of dimensions, and

    2 cov(x_i, x_j) = var(x_i + x_j) - var(x_i) - var(x_j)

gives all cross-covariances. Both steps are exact: with S the sums over the n rows, a centred
value n x - S is held as n y - r, where y is the distance of x from the whole part of the mean
and 0 <= r < n. Every task adds up y and y squared as whole numbers and turns them into the
squares of n y - r, which meet as ``decimal(38, 0)``: two numbers per task and pair of
dimensions, whatever the number of rows. The d (d + 1) / 2 totals go to the driver, where
``eigh`` takes the covariance rounded once to doubles.

Defined results: rows whose vector is null or holds null or non-finite entries take no part;
shorter vectors count as padded with zeros; null and repeated ids stay, each row on its own;
equal eigenvalues stand in any order; components without variance (a constant dimension, fewer
rows than dimensions, repeated rows only) cannot be scaled to one and are left out, so equal
rows, one row or none give an empty result. Entries whose whole number would pass 2**52 and
deviations beyond a long stop the job with an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.llm.storage import written

SCALE = 64.0
SHIFT = 1_000_000
BLOCK = 1024

_LIMIT = 2.0**52
_TOTALS = pa.schema([("slot", pa.int32()), ("total", pa.decimal128(38, 0))])
_TOTALS_SQL = "slot int, total decimal(38, 0)"


def usable(vector: Column) -> Column:
    """True where no entry is null or non-finite; false for a null vector."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _steps(column: pa.ListArray, width: int) -> Iterator[np.ndarray]:
    """floor(64 c) of consecutive rows as matrices of ``width`` columns."""
    for at in range(0, len(column), BLOCK):
        part = column.slice(at, BLOCK)
        lengths = part.value_lengths().to_numpy(zero_copy_only=False)
        c = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if np.abs(c).max(initial=0.0) * SCALE >= _LIMIT:
            raise ValueError("an embedding entry is too large to be whitened in whole numbers")
        out = np.zeros((len(part), width), np.int64)
        row = np.repeat(np.arange(len(part)), lengths)
        place = np.arange(len(c)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[row, place] = np.floor(SCALE * c).astype(np.int64)
        yield out


def _exact_total(values: np.ndarray) -> list[int]:
    """Column sums of whole numbers, as Python integers where a long might not hold them."""
    top = int(np.abs(values).max(initial=0))
    if top * len(values) >= 1 << 63:
        values = values.astype(object)
    return [int(t) for t in values.sum(0)]


def _exact_squares(values: np.ndarray) -> list[int]:
    top = int(np.abs(values).max(initial=0))
    if top * top * len(values) >= 1 << 63:
        values = values.astype(object)
        return [int(t) for t in (values * values).sum(0)]
    return [int(t) for t in np.einsum("rc,rc->c", values, values)]


def _rows(totals: dict[int, int]) -> pa.RecordBatch:
    slots, sums = list(totals), [Decimal(t) for t in totals.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(slots, pa.int32()), pa.array(sums, pa.decimal128(38, 0))], schema=_TOTALS
    )


def _gathered(partials: DataFrame) -> dict[int, int]:
    """Totals by slot; there are as many as dimensions, or pairs of them."""
    totals = partials.groupBy("slot").agg(F.sum("total").alias("total"))
    return {r["slot"]: int(r["total"]) for r in totals.collect()}


@dataclass(frozen=True)
class Whitening:
    """What the fit rows say: exact moments, and components by falling eigenvalue."""

    n: int
    floors: np.ndarray  # whole parts of the means of floor(64 c)
    rests: np.ndarray  # n * mean - n * floors, from 0 up to n
    covariance: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray  # one unit eigenvector a row

    @property
    def width(self) -> int:
        return len(self.floors)

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / np.trace(self.covariance)

    @property
    def sums(self) -> list[int]:
        """S of every dimension."""
        pairs = zip(self.floors, self.rests, strict=True)
        return [self.n * (int(m) + SHIFT) + int(r) for m, r in pairs]


def fit_whitening(vectors: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening:
    """The whitening of all usable rows of ``vectors``; at most ``components`` components."""
    fit = vectors.filter(usable(F.col(vector))).select(F.col(vector).alias("v"))
    n, width = fit.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * width
        for batch in batches:
            for x in _steps(batch.column(0), width):
                totals = [a + b for a, b in zip(totals, _exact_total(x), strict=True)]
        yield _rows(dict(enumerate(totals)))

    means = _gathered(fit.mapInArrow(sums, _TOTALS_SQL))
    whole = [divmod(means.get(i, 0), n) if n else (0, 0) for i in range(width)]
    floors = np.array([w[0] for w in whole], np.int64)
    rests = [w[1] for w in whole]
    left, right = np.triu_indices(width)  # slot s is the pair (left[s], right[s])

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Squares of n y - r for dimensions, and for sums of pairs of dimensions."""
        count, first, second = 0, [0] * len(left), [0] * len(left)
        for batch in batches:
            for x in _steps(batch.column(0), width):
                y = x - floors
                count += len(y)
                at = 0
                for i in range(width):
                    u = y[:, i:] + y[:, i : i + 1]
                    u[:, 0] = y[:, i]  # the pair (i, i) stands for the dimension itself
                    sums, squared = _exact_total(u), _exact_squares(u)
                    for j in range(width - i):
                        first[at + j] += sums[j]
                        second[at + j] += squared[j]
                    at += width - i
        totals = {}
        for s, (i, j) in enumerate(zip(left, right, strict=True)):
            r = rests[i] if i == j else rests[i] + rests[j]
            totals[s] = n * n * second[s] - 2 * n * r * first[s] + count * r * r
        yield _rows(totals)

    found = _gathered(fit.mapInArrow(squares, _TOTALS_SQL)) if n and width else {}
    own = {int(i): found.get(s, 0) for s, (i, j) in enumerate(zip(left, right, strict=True)) if i == j}
    covariance = np.zeros((width, width))
    for s, (i, j) in enumerate(zip(left, right, strict=True)):
        # The squares are n**2 times too large, their sum n times.
        twice = 2 * own[i] if i == j else found.get(s, 0) - own[i] - own[j]
        covariance[i, j] = covariance[j, i] = twice / (2 * n**3) if n else 0.0
    values, columns = np.linalg.eigh(covariance) if width else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")[:components]
    noise = values.max(initial=0.0) * max(width, 1) * np.finfo(float).eps * 8
    order = order[values[order] > noise]
    return Whitening(
        n, floors, np.array(rests, np.float64), covariance, values[order], columns[:, order].T
    )


def _deviations(x: np.ndarray, model: Whitening, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S) squared, exact."""
    shifted = x + SHIFT
    top = max((abs(s) for s in sums), default=0) + model.n * int(np.abs(shifted).max(initial=0))
    if top >= 1 << 62:
        shifted = shifted.astype(object)
        centred = model.n * shifted - np.array(sums, object)
    else:
        centred = model.n * shifted - np.array(sums, np.int64)
    far = int(np.abs(centred).max(initial=0))
    if far * far * max(1, model.width) >= 1 << 63:
        centred = centred.astype(object)
    out = [int(t) for t in (centred * centred).sum(1)]
    if max(out, default=0) >= 1 << 63:
        raise OverflowError("a deviation is beyond a long")
    return out


def whiten(model: Whitening, vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Usable rows with ``deviation`` and ``whitened``, one entry per component.

    Other columns stay as they are in the struct ``row``.
    """
    kept = vectors.filter(usable(F.col(vector)))
    sums = model.sums
    scaled = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    means = model.floors + model.rests / max(model.n, 1)

    @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
    def project(column: pa.Array) -> pa.Array:
        far: list[int] = []
        values = [np.zeros((0, scaled.shape[1]))]
        for x in _steps(column, model.width):
            far += _deviations(x, model, sums)
            # The whole part of the mean goes first: what is left is small and exact.
            values.append(((x - model.floors) - (means - model.floors)) @ scaled)
        flat = np.concatenate(values).ravel()
        ends = np.arange(len(column) + 1) * scaled.shape[1]
        whitened = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array(far, pa.int64()), whitened], ["deviation", "whitened"])

    done = kept.select(
        F.struct("*").alias("row"), project(F.col(vector)).alias("p")
    )
    return done.select("row", "p.deviation", "p.whitened")


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest entry of |covariance - identity| of the column ``whitened``, 0 without rows.

    The means are taken first and every value is centred before it is multiplied.
    """
    n = whitened.count()
    if not n or not components:
        return 0.0
    parts = whitened.select(F.posexplode("whitened").alias("i", "w"))
    means = np.zeros(components)
    for r in parts.groupBy("i").agg(F.avg("w").alias("mean")).collect():  # one row a component
        means[r["i"]] = r["mean"]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components, components))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                w = batch.column(0).slice(at, BLOCK).flatten().to_numpy().reshape(-1, components)
                total += (w - means).T @ (w - means)
        slot = np.arange(components**2)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(total.ravel())], ["slot", "total"])

    sums = whitened.select("whitened").mapInArrow(products, "slot int, total double")
    got = sums.groupBy("slot").agg(F.sum("total").alias("total")).collect()
    found = np.zeros(components**2)
    for r in got:  # the square of the number of components
        found[r["slot"]] = r["total"] / n
    return float(np.abs(found.reshape(components, components) - np.eye(components)).max())


def whitening_report(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 32
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, see above."""
    model = fit_whitening(vectors, vector, components)
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"))
    found = whiten(model, named, "v").select("row.vec_id", "deviation", "whitened")
    found = written(found, "whitened")
    error = identity_error(found, len(model.eigenvalues))
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    parts = found.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return parts.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
