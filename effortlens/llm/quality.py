"""Quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

A document's own evidence is the log-odds of a logistic model over the shape of its text
(shares of character kinds, repetition, word lengths), fitted on a bounded sample of
labelled rows. Hosts and paths below them (here ``source`` and ``lang``) get posteriors by
grouped aggregation over *all* documents: a host's expected good share is shrunk toward the
corpus share, a path's toward its host's, each with a pseudo-count of ``strength`` documents,
so sparse sites stay near the prior. The site's log-odds against the corpus then shift the
document's, weighted by ``site_weight``.

Defined results: a null or empty text has the evidence of an all-zero shape and is rejected;
null hosts and paths are sites of their own; repeated rows are scored alike and each counts;
an empty table gives an empty result; without usable labels the evidence is 0 for all texts
that have words. ``filter_quality`` returns the columns it was given, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.llm.splits import is_held_out
from effortlens.llm.storage import written
from effortlens.llm.words import slices, text_bytes

FIT_ROWS = 4000  # labelled rows that the document model is fitted on, at most
STRENGTH = 20.0
SITE_WEIGHT = 0.5
THRESHOLD = 0.5

_EMPTY = -20.0  # evidence of a text without words


def _kinds() -> np.ndarray:
    """Byte to kind: 0 other, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 blank."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = 5
    kind[0x61:0x7B], kind[0x41:0x5B], kind[0x30:0x3A] = 1, 2, 3
    kind[[ord(c) for c in ".,;:'\"()-?"]] = 4
    kind[[9, 10, 13, 32]] = 6
    return kind


_KIND = _kinds()
N_FEATURES = 14


def features(texts: pa.Array) -> np.ndarray:
    """A row of shape features for each text; all zero where it has no word."""
    parts = [np.zeros((0, N_FEATURES))]
    for at, to, w in slices(texts):
        raw, cut = text_bytes(texts.slice(at, to - at))
        n, size = to - at, np.maximum(np.diff(cut), 1)
        kind = _KIND[raw]
        share = np.empty((6, n))
        run = np.zeros(len(raw) + 1, np.int64)  # of one kind at a time: 8 bytes a byte of text
        for k in range(6):
            np.cumsum(kind == k, out=run[1:])
            share[k] = (run[cut[1:]] - run[cut[:-1]]) / size
        count = np.maximum(w.counts, 1)
        text = w.text
        length = (w.end - w.start).astype(float)
        mean = np.bincount(text, length, n) / count
        order = np.lexsort((w.hash, text))
        new = np.ones(len(order), bool)
        new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (text[order][1:] != text[order][:-1])
        distinct = np.bincount(text[order][new], minlength=n)
        runs = np.diff(np.append(np.flatnonzero(new), len(order)))
        most = np.zeros(n)
        np.maximum.at(most, text[order][new], runs)
        twice = (w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])
        again = np.bincount(text[1:][twice], minlength=n) / count
        short = np.bincount(text, length <= 3, n) / count
        long = np.bincount(text, length >= 20, n) / count
        gap = (w.start[1:] - w.end[:-1])[text[1:] == text[:-1]]
        gap_text = text[1:][text[1:] == text[:-1]]
        wide = np.bincount(gap_text, gap >= 3, n) / count
        x = np.column_stack(
            [share.T, np.log1p(mean), np.log(count), distinct / count, most / count]
            + [again, short, long, wide]
        )
        x[w.counts == 0] = 0
        parts.append(x)
    return np.concatenate(parts)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first is the constant."""
    a = np.column_stack([np.ones(len(x)), x])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (y - p) - penalty * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class DocumentModel:
    """Standardised shape features, their squares and their small values, weighed."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _wide(x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, x**2, np.minimum(x, 0.05)])

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> DocumentModel:
        wide = cls._wide(x)
        if len(set(y.tolist())) < 2:
            n = wide.shape[1]
            return cls(np.zeros(n), np.ones(n), np.zeros(n + 1))
        mean, scale = wide.mean(0), wide.std(0) + 1e-9
        return cls(mean, scale, logistic((wide - mean) / scale, y))

    def evidence(self, texts: pa.Array) -> np.ndarray:
        x = features(texts)
        z = (self._wide(x) - self.mean) / self.scale
        logit = np.clip(self.weights[0] + z @ self.weights[1:], -20, 20)
        return np.where((x == 0).all(1), _EMPTY, logit)


def fit_documents(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = FIT_ROWS,
) -> DocumentModel:
    """Fit on at most ``rows`` labelled rows, the first by a hash of their id.

    Held-out rows (see ``splits``) are left out, so accuracy can be measured on them.
    """
    named = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("y"))
    usable = named.filter("id is not null and y is not null").filter(~is_held_out(F.col("id")))
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # The sample has at most ``rows`` rows of two numbers.
    labelled = texts.join(F.broadcast(sample), "id").select("text", "y")

    def measure(batches):
        for batch in batches:
            x = features(batch.column(0))
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(list(x), pa.list_(pa.float64())), "y": batch.column(1)}
            )

    got = labelled.mapInArrow(measure, "x array<double>, y double").collect()
    x = np.array([r["x"] for r in got]).reshape(-1, N_FEATURES)
    return DocumentModel.fit(x, np.array([r["y"] for r in got]))


def evidence_column(model: DocumentModel, text: Column) -> Column:
    """The document's own log-odds of being good.

    Marked as nondeterministic, though it is not: else Spark evaluates it once more for each
    filter that it infers (of a join: that it is not null), in Python workers of their own.
    """

    @F.arrow_udf("double")
    def evidence(texts: pa.Array) -> pa.Array:
        return pa.array(model.evidence(texts))

    return evidence.asNondeterministic()(text)


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_posteriors(
    docs: DataFrame,
    model: DocumentModel,
    host: str = "source",
    path: str = "lang",
    text: str = "text",
    strength: float = STRENGTH,
) -> DataFrame:
    """``host``, ``path``, their shrunken good shares and the log-odds ``shift`` of the path."""
    scored = docs.select(
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        (1 / (1 + F.exp(-evidence_column(model, F.col(text))))).alias("good"),
    )
    paths = written(
        scored.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")),
        "quality-paths",
    )
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    prior = min(max((total["good"] or 0.0) / (total["n"] or 1), 1e-6), 1 - 1e-6)
    hosts = paths.groupBy(F.col("host").alias("of_host")).agg(
        ((F.sum("good") + strength * prior) / (F.sum("n") + strength)).alias("host_quality")
    )
    quality = (F.col("good") + strength * F.col("host_quality")) / (F.col("n") + strength)
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).select(
        "host", "path", "host_quality", quality.alias("path_quality")
    )
    bounded = F.greatest(F.least(F.col("path_quality"), F.lit(1 - 1e-6)), F.lit(1e-6))
    shift = _odds(bounded) - F.lit(float(np.log(prior / (1 - prior))))
    return written(sites.withColumn("shift", shift), "quality-sites")


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
    strength: float = STRENGTH,
    site_weight: float = SITE_WEIGHT,
) -> DataFrame:
    """Rows as ``row`` with ``evidence``, ``host_quality``, ``path_quality`` and ``score``.

    The evidence is computed in two passes over the texts rather than joined back to them, so
    no text is shuffled where the table of sites is small.
    """
    model = fit_documents(docs, labels, doc_id, text)
    sites = site_posteriors(docs, model, host, path, text, strength)
    rows = docs.select(
        F.struct("*").alias("row"), evidence_column(model, F.col(text)).alias("evidence")
    )
    same = F.col(f"row.`{host}`").eqNullSafe(F.col("host")) & F.col(f"row.`{path}`").eqNullSafe(
        F.col("path")
    )
    logit = F.col("evidence") + site_weight * F.col("shift")
    return rows.join(sites, same).select(
        "row",
        "evidence",
        "host_quality",
        "path_quality",
        (1 / (1 + F.exp(-logit))).alias("score"),
    )


def filter_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how
) -> DataFrame:
    """The rows that score at least ``threshold``, with the columns they came with."""
    scored = score_quality(docs, labels, **how)
    return scored.filter(F.col("score") >= threshold).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
