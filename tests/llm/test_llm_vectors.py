"""Whitening and hard negatives against brute force, and their defined results at the edges."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from effortlens.llm import negatives, queries, whitening

EDGES = [
    (100, [0.5, -0.25, 0.0], 1),
    (101, [0.5, -0.25, 0.0], 1),  # the same vector under another id
    (102, [0.4, 0.1], 1),  # shorter
    (103, None, 1),
    (104, [0.1, None, 0.3], 1),
    (105, [float("nan"), 0.0, 0.0], 1),
    (106, [float("inf"), 0.0, 0.0], 2),
    (107, [0.3, 0.3, 0.3], None),
    (None, [0.2, -0.4, 0.6], 2),
    (200, [0.45, -0.2, 0.1], 2),
    (200, [0.45, -0.2, 0.1], 2),  # a repeated row
    (201, [0.45, -0.2, 0.05], 2),
    (300, [], 3),
]
EDGE_SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def edges(spark):
    extra = ["n", "row", "v", "vector", "p", "block", "kind", "whitened", "positives", "a b.c"]
    frame = spark.createDataFrame(EDGES, EDGE_SCHEMA)
    return frame.select("*", *[F.lit("mine").alias(c) for c in extra])


def whole(rows, scale, shift=0):
    """Vectors that take part as whole numbers, padded with zeros."""
    kept = [
        (i, v, k)
        for i, v, k in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max((len(v) for _, v, _ in kept), default=0)
    return [
        (i, [math.floor(scale * float(np.float32(x))) + shift for x in v + [0] * (width - len(v))], k)
        for i, v, k in kept
    ]


def check_whitening(rows, got, components=32):
    """``got`` against covariances of fractions, and deviations of Python integers."""
    held = whole(rows, 64, 1_000_000)
    n, x = len(held), [v for _, v, _ in held]
    sums = [sum(c) for c in zip(*x)]
    far = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = [[Fraction(n * a - s, n) for a, s in zip(v, sums)] for v in x]
    d = len(sums)
    cov = np.array(
        [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(d)] for i in range(d)]
    )
    values, vectors = np.linalg.eigh(cov)
    order = [i for i in np.argsort(-values) if values[i] > 1e-9 * values.max()][:components]
    expected = np.array([[float(a) for a in c] for c in centred]) @ vectors[:, order]
    expected /= np.sqrt(values[order])
    by_component = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[order[r.component - 1]] / np.trace(cov), rel=1e-9)
        by_component.setdefault(r.component, []).append((str(r.vec_id), r.deviation, r.whitened))
    assert sorted(by_component) == list(range(1, len(order) + 1))
    for component, found in by_component.items():
        ids = [str(i) for i, _, _ in held]
        assert sorted(f[:2] for f in found) == sorted(zip(ids, far))
        want = sorted(zip(ids, far, expected[:, component - 1]))
        flipped = sorted(zip(ids, far, -expected[:, component - 1]))
        near = [np.allclose([f[2] for f in sorted(found)], [w[2] for w in e], atol=1e-7) for e in (want, flipped)]
        assert any(near), component


def test_whitening_equals_exact_covariances(spark, sf_dir):
    rows = queries.op11_whitening(spark, sf_dir).collect()
    table = queries.table(spark, sf_dir, "embeddings").collect()
    check_whitening([(r.vec_id, r.embedding, r.label) for r in table], rows)


def test_whitening_edges(edges):
    check_whitening(EDGES, whitening.whitening_report(edges).collect())


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0], 1)], [(1, [0.5], 1)] * 3, [(1, None, 1)], [(1, [], 1)]])
def test_whitening_without_variance_is_empty(spark, rows):
    assert whitening.whitening_report(spark.createDataFrame(rows, EDGE_SCHEMA)).count() == 0


def test_whitening_of_large_entries_stays_exact(spark):
    """Squares beyond a long are added as Python integers; deviations beyond one stop the job."""
    rows = [(i, [float(2**26 * i), float(i % 3)], 0) for i in range(4)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="beyond a long"):
        whitening.whitening_report(vectors).collect()
    model = whitening.fit_whitening(vectors)
    assert model.sums == [64 * 2**26 * 6 + 4 * 1_000_000, 64 * 3 + 4 * 1_000_000]
    assert model.covariance[0, 0] == (64 * 2**26) ** 2 * 1.25
    with pytest.raises(Exception, match="too large"):
        whitening.fit_whitening(vectors.withColumn("embedding", F.array(F.lit(1e300))))


def test_polarised_totals_do_not_depend_on_the_tasks(spark, sf_dir):
    table = queries.table(spark, sf_dir, "embeddings")
    one, many = (whitening.fit_whitening(table.repartition(n)) for n in (1, 7))
    assert np.array_equal(one.covariance, many.covariance) and one.sums == many.sums


def mined(rows, anchor, k=5):
    """Hard negatives by comparing all rows; rows are (id, whole numbers, label)."""
    out = []
    asked = {}
    for i, v, label in rows:
        if anchor(i):
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    for a, (label, v) in asked.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, w, m in rows if i != a]
        for ps, p, _ in sorted(s for s in scored if s[2] == label)[:k]:
            fits = sorted(s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps)
            out += [(a, p, r, q, -ps, -qs) for r, (qs, q, _) in enumerate(fits[:k], 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, sf_dir):
    got = queries.op13_hard_negatives(spark, sf_dir).collect()
    table = queries.table(spark, sf_dir, "embeddings").collect()
    moved = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    assert sorted(map(tuple, got)) == mined(whole(moved, 256), lambda i: i % 100 == 0)


@pytest.mark.parametrize("block_rows", [1, 3, 100])
def test_hard_negative_edges(edges, block_rows):
    got = negatives.hard_negatives(edges, F.col("vec_id") % 100 == 0, block_rows=block_rows).collect()
    rows = [r for r in whole(EDGES, 256) if r[0] is not None and r[2] is not None]
    assert sorted(map(tuple, got)) == mined(rows, lambda i: i % 100 == 0)


def test_hard_negatives_of_no_rows(spark):
    for rows in ([], [(100, None, 1)], [(100, [1.0], 1)]):
        frame = spark.createDataFrame(rows, EDGE_SCHEMA)
        assert negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0).count() == 0


def test_hard_negatives_among_many_equal_rows(spark):
    """A vector and a label that hold most rows: ties go to the smaller id."""
    rows = [(i, [0.5, 0.5], 1 if i < 40 else 2) for i in range(120)] + [(900, [0.5, 0.45], 1)]
    frame = spark.createDataFrame(rows, EDGE_SCHEMA)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, block_rows=16).collect()
    assert sorted(map(tuple, got)) == mined(whole(rows, 256), lambda i: i % 100 == 0)


def test_too_large_components_stop_the_job(spark):
    frame = spark.createDataFrame([(100, [1e30], 1), (101, [1e30], 1)], EDGE_SCHEMA)
    with pytest.raises(Exception, match="too large"):
        negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0).collect()


def test_products_beyond_a_long_raise():
    big = np.array([[2**40, 2**40]])
    assert negatives.inner(big, np.array([2**20, 1])).tolist() == [2**60 + 2**40]
    with pytest.raises(OverflowError):
        negatives.inner(big, big[0])


def test_intervals_hold_and_pass_over_most_rows(spark):
    draw = np.random.default_rng(5)
    x = np.floor(256 * draw.standard_normal((4000, 64)) / 8).astype(np.int64)
    turned = negatives.rotations(64)
    codes, align, rest, gg = negatives.encode(x, turned)
    labels = np.zeros(len(x), np.int32)
    block = negatives.Block(np.arange(len(x)), labels, x, codes.T.copy(), align, rest, gg, turned)
    shares = []
    for a in x[:20]:
        _, low, high = block.intervals(a)
        exact = x @ a
        assert (low <= exact).all() and (exact <= high).all()
        shares.append((high >= np.sort(exact)[-6]).mean())
    assert np.mean(shares) < 0.2
