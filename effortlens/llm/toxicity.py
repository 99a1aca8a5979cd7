"""Toxicity by class-conditional Kneser-Ney models of words.

Each class (toxic, ordinary) has an interpolated Kneser-Ney model of the bytes of a word: the
longest context is counted in that class, tokens and all, while every shorter one is shared by
both classes and counted over the distinct words of the *whole* corpus, one per word, as
Kneser-Ney counts types. A rare expression thus backs off to the same counts in both classes
and moves the score only by what a class itself has shown. A word's evidence is the difference
of its log-likelihoods; a text's features are the mean evidence of all its words, the mean of
its strongest few (also capped), and the median, which is what the text's language alone is worth. A logistic calibration on a part of
the labelled rows that the models were not counted on turns these into a probability.

Bounds: the calibration comes from at most ``CALIBRATION_ROWS`` labelled rows, the first by a
hash of the id. The shared counts cover all documents, the class counts all labelled rows
outside the calibration and the held-out part (see ``splits``), and all are written tables
that nothing is cut from. Where each has at most ``MAX_GRAMS`` grams, tasks receive the tables
whole; beyond, each distinct gram and word is rated once by joins, and the words' evidence is
joined to the texts. The scores are the same either way, and see texts only.

Defined results: a null or wordless text has all features 0, as a text without evidence;
without toxic or without ordinary rows to learn from every score is 0; repeated rows are
scored alike; an empty table gives an empty result; other columns pass through untouched. Equal
rows of ``labels`` count once; an id labelled both ways counts in both classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.llm.idmap import maybe_among
from effortlens.llm.quality import logistic
from effortlens.llm.splits import is_held_out
from effortlens.llm.storage import written
from effortlens.llm.words import Words, mix, slices

ORDER = 5
CALIBRATION_ROWS = 3000
MAX_GRAMS = 1 << 20  # of a table that tasks receive whole
DISCOUNT = 0.75
STRONGEST = 4
STRONG_ENOUGH = 5.0  # evidence beyond this counts less
THRESHOLD = 0.3
SLICE_BYTES = 2 << 20  # of text whose words are told apart at a time
KEPT_WORDS = 1 << 19  # words that a task remembers, about 8 MiB; beyond, it starts anew

_U = np.uint64
_START, _STOP = 1, 2
_COUNTED = "gram long, context long, n long"


class Grams:
    """The bytes of some words between a start and a stop mark, and hashes of their grams.

    ``depth`` is how many bytes the longest gram that ends at a byte has; ``event`` is false
    at start marks only.
    """

    def __init__(self, words: Words, which: np.ndarray):
        start, length = words.start[which], words.end[which] - words.start[which] + 2
        first = np.cumsum(length) - length
        self.word = np.repeat(np.arange(len(which), dtype=np.int32), length)
        rel = np.arange(len(self.word)) - first[self.word]
        inner = (rel > 0) & (rel < length[self.word] - 1)
        marks = np.where(rel == 0, _START, _STOP).astype(np.uint8)
        marks[inner] = words.lower[(start[self.word] + rel - 1)[inner]]
        self._marks = marks
        self.depth = np.minimum(rel + 1, ORDER).astype(np.int8)
        self.event = rel > 0

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For k = 1 to ORDER the hashes of the k bytes that end at each byte, and of the
        k - 1 bytes before it; one level at a time is held."""
        step = mix(np.arange(256, dtype=np.uint64))[self._marks]
        gram = step
        yield 1, gram, np.zeros(len(step), np.uint64)
        for k in range(2, ORDER + 1):
            before = np.concatenate([[_U(0)], gram[:-1]])
            gram = mix(before * _U(0x9E3779B97F4A7C15) + step + _U(k))
            yield k, gram, mix(before + _U(k))

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        gram, context = np.zeros((2, len(self.word)), np.uint64)
        for k, g, c in self.levels():
            at = self.depth == k
            gram[at], context[at] = g[at], c[at]
        return gram, context


def _summed(gram: np.ndarray, context: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    code, at, inverse = np.unique(gram, return_index=True, return_inverse=True)
    total = np.bincount(inverse, n, len(code)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(x.view(np.int64)) for x in (code, context[at], total)], ["gram", "context", "n"]
    )


class Table:
    """Counts of grams, and by context the total and the number of different followers."""

    def __init__(self, gram: np.ndarray, context: np.ndarray, n: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.n = gram[order], n[order].astype(np.float64)
        self.context, inverse = np.unique(context, return_inverse=True)
        self.total = np.bincount(inverse, n, len(self.context))
        self.followers = np.bincount(inverse, minlength=len(self.context)).astype(np.float64)

    @classmethod
    def collected(cls, counts: DataFrame) -> Table:
        """Of all grams, ``MAX_GRAMS`` at most."""
        gram, context, n = (c.to_numpy() for c in counts.toArrow().columns)
        return cls(gram.astype(np.int64).view(np.uint64), context.astype(np.int64).view(np.uint64), n)

    @staticmethod
    def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return at, keys[at] == asked

    def smooth(self, gram: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Discounted share of the gram in its context, the rest spread like ``lower``."""
        g, seen = self._find(self.gram, gram)
        c, known = self._find(self.context, context)
        out = lower.copy()
        n = np.where(seen[known], self.n[g[known]], 0.0) if len(self.gram) else np.zeros(0)
        c = c[known]
        out[known] = (
            np.maximum(n - DISCOUNT, 0) + DISCOUNT * self.followers[c] * lower[known]
        ) / self.total[c]
        return out


def _summaries(value: np.ndarray, text: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of texts of so many words, from all words' evidence in order of text."""
    n, count, first = len(counts), np.maximum(counts, 1), np.cumsum(counts) - counts
    order = np.lexsort((-value, text))
    place = np.arange(len(order)) - np.repeat(first, counts)
    top = place < STRONGEST
    strongest = np.bincount(text[order][top], value[order][top], n)
    middle = np.zeros(n)
    some = counts > 0
    middle[some] = value[order][(first + counts // 2)[some]]
    mean = np.bincount(text, value, n) / count
    top_mean = strongest / np.minimum(count, STRONGEST)
    return np.column_stack([mean, top_mean, np.minimum(top_mean, STRONG_ENOUGH), middle])


class WordValues:
    """Values of words that a task has met, by hash; forgets all when it holds ``KEPT_WORDS``."""

    def __init__(self):
        self.code, self.value = np.zeros(0, np.uint64), np.zeros(0)

    def missing(self, code: np.ndarray) -> np.ndarray:
        """Which of these distinct hashes are not known."""
        if not len(self.code):
            return np.ones(len(code), bool)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return self.code[at] != code

    def add(self, code: np.ndarray, value: np.ndarray) -> None:
        code = np.concatenate([self.code, code])
        order = np.argsort(code)
        self.code, self.value = code[order], np.concatenate([self.value, value])[order]

    def of(self, code: np.ndarray, rate: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The values of distinct hashes; ``rate`` gives those of the unknown, by their indices."""
        if len(self.code) > KEPT_WORDS:
            self.__init__()
        new = np.flatnonzero(self.missing(code))
        if len(new):
            self.add(code[new], rate(new))
        return self.value[np.searchsorted(self.code, code)]


@dataclass
class ToxicityModel:
    shared: Table
    toxic: Table
    ordinary: Table
    weights: np.ndarray | None = None  # of the constant and the features

    def evidence(self, words: Words, which: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of each word with these indices."""
        g = Grams(words, which)
        lower = np.full(len(g.word), 1 / 256)
        gram, context = np.zeros((2, len(g.word)), np.uint64)
        for k, level, before in g.levels():
            at = g.depth == k
            gram[at], context[at] = level[at], before[at]
            at = g.event & (g.depth > k)
            lower[at] = self.shared.smooth(level[at], before[at], lower[at])
        gram, context, lower = gram[g.event], context[g.event], lower[g.event]
        ratio = np.log(self.toxic.smooth(gram, context, lower)) - np.log(
            self.ordinary.smooth(gram, context, lower)
        )
        word = g.word[g.event]
        return np.bincount(word, ratio, len(which))

    def features(self, texts: pa.Array, known: WordValues | None = None) -> np.ndarray:
        """For each text the mean evidence of its words, of its strongest ones, and the median.

        ``known`` holds the evidence of words met before, so that a task rates each word once.
        """
        known = known or WordValues()
        parts = [np.zeros((0, 4))]
        for at, to, words in slices(texts, SLICE_BYTES):
            n = to - at
            code, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
            value = np.zeros(0)
            if len(code):
                value = known.of(code, lambda new: self.evidence(words, first[new]))[inverse]
            parts.append(_summaries(value, words.text, words.counts))
        return np.concatenate(parts)

    def score(self, texts: pa.Array, known: WordValues | None = None) -> np.ndarray:
        x = self.features(texts, known)
        if self.weights is None:
            return np.zeros(len(x))
        logit = self.weights[0] + x @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class JoinedModel:
    """The same model over count tables too large to send to tasks."""

    shared: DataFrame
    toxic: DataFrame
    ordinary: DataFrame
    weights: np.ndarray | None = None

    def _word_evidence(self, texts: DataFrame) -> DataFrame:
        """``word`` (hash) and ``value`` of each distinct word of the texts."""
        grams = _word_grams(written(_corpus_words(texts), "words"))
        asked = written(grams.drop("word").distinct(), "asked-grams")
        lower = None
        for k in range(1, ORDER):
            rows = asked.filter(f"level = {k} and not longest")
            if lower is None:
                rows = rows.withColumn("lower", F.lit(1 / 256))
            else:
                rows = rows.join(lower.withColumnRenamed("gram", "suffix"), "suffix")
            level = written(_smoothed(rows, self.shared).select("gram", F.col("p").alias("lower")), "gram-shares")
            lower = level if lower is None else lower.unionByName(level)
        rows = asked.filter("longest").join(lower.withColumnRenamed("gram", "suffix"), "suffix")
        rows = _smoothed(rows, self.toxic).withColumnRenamed("p", "toxic")
        rows = _smoothed(rows, self.ordinary)
        rated = written(rows.select("gram", (F.log("toxic") - F.log("p")).alias("value")), "gram-evidence")
        ends = grams.filter("longest").select("word", "gram")
        return written(
            ends.join(rated, "gram").groupBy("word").agg(F.sum("value").alias("value")), "word-evidence"
        )

    def features(self, texts: DataFrame) -> DataFrame:
        """``k1``, ``k2`` and features ``x`` of each distinct text (k1, k2, text) with words."""
        tokens = texts.mapInArrow(_tokens, "k1 long, k2 long, word long, n long")
        # Repeated texts are reduced before the shuffle.
        tokens = tokens.groupBy("k1", "k2", "word").agg(F.first("n").alias("n"))
        rated = tokens.join(self._word_evidence(texts.select("text")), "word")
        listed = rated.groupBy("k1", "k2").agg(F.collect_list(F.struct("value", "n")).alias("words"))
        return listed.select(
            "k1", "k2", F.col("words.value").alias("value"), F.col("words.n").alias("n")
        ).mapInArrow(_listed_features, "k1 long, k2 long, x array<double>")


def _keyed(text: Column) -> dict[str, Column]:
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(7), text, F.length(text))}


def _tokens(batches):
    for batch in batches:
        k1, k2 = (c.to_numpy() for c in batch.columns[:2])
        for at, _, words in slices(batch.column(2), SLICE_BYTES):
            order = np.lexsort((words.hash, words.text))
            text, code = words.text[order], words.hash[order]
            new = np.ones(len(code), bool)
            new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
            first = np.flatnonzero(new)
            yield pa.RecordBatch.from_pydict(
                {
                    "k1": k1[at + text[first]],
                    "k2": k2[at + text[first]],
                    "word": code[first].view(np.int64),
                    "n": np.diff(np.append(first, len(code))),
                }
            )


def _listed_features(batches):
    for batch in batches:
        values, numbers = (c.flatten().to_numpy() for c in batch.columns[2:])
        sizes = batch.column(2).value_lengths().to_numpy()
        text = np.repeat(np.repeat(np.arange(len(sizes)), sizes), numbers)
        x = _summaries(np.repeat(values, numbers), text, np.bincount(text, minlength=len(sizes)))
        yield pa.RecordBatch.from_pydict(
            {"k1": batch.column(0), "k2": batch.column(1), "x": pa.array(list(x), pa.list_(pa.float64()))}
        )


def _word_grams(vocabulary: DataFrame) -> DataFrame:
    """Of every word the grams that rate its bytes, with what each falls back on."""

    def expand(batches):
        for batch in batches:
            joined = pa.array([b" ".join(batch.column(0).to_pylist())], pa.binary()).cast(pa.string())
            for _, _, words in slices(joined):
                g = Grams(words, np.arange(len(words.start)))
                suffix = np.zeros(len(g.word), np.uint64)
                for k, gram, context in g.levels():
                    at = g.event & (g.depth >= k)
                    codes = [x[at].view(np.int64) for x in (words.hash[g.word], gram, context, suffix)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(at.sum(), k, np.int32)), pa.array(g.depth[at] == k), *map(pa.array, codes)],
                        ["level", "longest", "word", "gram", "context", "suffix"],
                    )
                    suffix = gram

    return vocabulary.mapInArrow(
        expand, "level int, longest boolean, word long, gram long, context long, suffix long"
    )


def _smoothed(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``Table.smooth`` as ``p``, of rows with gram, context and ``lower``. No context has more
    than 256 grams, and rows are distinct grams, so no key of these joins is hot."""
    totals = counts.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("followers"))
    seen = counts.select("gram", F.col("n").alias("seen"))
    share = (
        F.greatest(F.coalesce("seen", F.lit(0)) - DISCOUNT, F.lit(0.0))
        + DISCOUNT * F.col("followers") * F.col("lower")
    ) / F.col("total")
    both = rows.join(seen, "gram", "left").join(totals, "context", "left")
    return both.withColumn("p", F.coalesce(share, "lower")).drop("seen", "total", "followers")


def _corpus_words(texts: DataFrame) -> DataFrame:
    """The distinct words of all texts; a task sends a word again only after ``KEPT_WORDS``."""

    def distinct(batches):
        sent = WordValues()
        for batch in batches:
            for _, _, words in slices(batch.column(0), SLICE_BYTES):
                code, first = np.unique(words.hash, return_index=True)
                if len(sent.code) > KEPT_WORDS:
                    sent = WordValues()
                new = sent.missing(code)
                code, first = code[new], first[new]
                sent.add(code, np.zeros(len(code)))
                yield pa.RecordBatch.from_pydict(
                    {"word": pa.array([words.lower[words.start[i] : words.end[i]].tobytes() for i in first], pa.binary())}
                )

    return texts.mapInArrow(distinct, "word binary").distinct()


def _type_counts(vocabulary: DataFrame) -> DataFrame:
    """Counts of the shorter grams over distinct words."""

    def count(batches):
        for batch in batches:
            joined = pa.array([b" ".join(batch.column(0).to_pylist())], pa.binary()).cast(pa.string())
            for _, _, words in slices(joined):
                g = Grams(words, np.arange(len(words.start)))
                for k, gram, context in g.levels():
                    at = g.event & (g.depth > k)
                    yield _summed(gram[at], context[at], np.ones(at.sum()))

    return vocabulary.mapInArrow(count, _COUNTED).groupBy("gram", "context").agg(F.sum("n").alias("n"))


def _class_counts(texts: DataFrame) -> DataFrame:
    """Counts of the longest grams over all tokens."""

    def count(batches):
        for batch in batches:
            for _, _, words in slices(batch.column(0), SLICE_BYTES):
                _, first, n = np.unique(words.hash, return_index=True, return_counts=True)
                g = Grams(words, first)
                gram, context = g.longest()
                yield _summed(gram[g.event], context[g.event], n[g.word[g.event]])

    return texts.mapInArrow(count, _COUNTED).groupBy("gram", "context").agg(F.sum("n").alias("n"))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel | JoinedModel:
    """Count the models and fit the calibration; ``docs`` is scanned whole for shared counts."""
    named = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y"))
    usable = named.filter("id is not null and y in (0, 1)").filter(~is_held_out(F.col("id"))).distinct()
    # A quarter of the rows calibrates, the rest is counted.
    usable = usable.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(4)))
    order = (F.xxhash64("id"), F.col("id"))
    calibrating = usable.filter("part = 0").orderBy(*order).limit(CALIBRATION_ROWS)
    sample = written(usable.filter("part > 0").unionByName(calibrating), "labelled-ids")
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # Labels grow with the texts, so both are shuffled at every size, without the other texts.
    listed = maybe_among(texts, "id", sample.select("id"))
    labelled = listed.join(sample.hint("merge"), "id").select("text", "y", "part")
    labelled = written(labelled, "labelled-texts")
    vocabulary = _corpus_words(docs.select(F.col(text).alias("text")))
    counts = [written(_type_counts(vocabulary), "shared-grams")]
    for y in (1, 0):
        rows = labelled.filter(f"part > 0 and y = {y}").select("text")
        counts.append(written(_class_counts(rows), "class-grams"))
    sizes = [c.count() for c in counts]
    if max(sizes) <= MAX_GRAMS:
        model = ToxicityModel(*[Table.collected(c) for c in counts])
    else:
        model = JoinedModel(*counts)
    if not sizes[1] or not sizes[2]:
        return model

    rows = labelled.filter("part = 0").select("text", F.col("y").cast("double").alias("y"))
    got = _measured(model, rows, "text").select("x", "row.y").collect()
    if not got:
        return model
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got])
    scale = x.std(0) + 1e-9
    weights = logistic(x / scale, y, ridge=0.1)
    model.weights = np.concatenate([weights[:1], weights[1:] / scale])
    return model


def _measured(model: ToxicityModel | JoinedModel, df: DataFrame, text: str) -> DataFrame:
    """Rows as ``row`` with the features ``x`` of their text."""
    rows = df.select(F.struct("*").alias("row"))
    whole = F.col(f"row.`{text}`")
    if isinstance(model, ToxicityModel):

        known = WordValues()  # each task unpacks one of its own

        @F.arrow_udf("array<double>")
        def measure(texts: pa.Array) -> pa.Array:
            return pa.array(list(model.features(texts, known)), pa.list_(pa.float64()))

        return rows.select("row", measure(whole).alias("x"))
    keyed = rows.withColumns(_keyed(whole))
    found = model.features(keyed.select("k1", "k2", whole.alias("text")))
    none = F.array(*[F.lit(0.0)] * 4)
    return keyed.join(found, ["k1", "k2"], "left").select("row", F.coalesce("x", none).alias("x"))


def score_texts(model: ToxicityModel | JoinedModel, df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the probability ``score`` that a text is toxic; replaces such a column."""
    if isinstance(model, ToxicityModel):
        return df.withColumn("score", toxicity_score(model, F.col(text)))
    if model.weights is None:
        return df.withColumn("score", F.lit(0.0))
    logit = F.lit(float(model.weights[0]))
    for i, w in enumerate(model.weights[1:]):
        logit = logit + float(w) * F.col("x")[i]
    logit = F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))
    kept = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c != "score"]
    return _measured(model, df, text).select(*kept, (1 / (1 + F.exp(-logit))).alias("score"))


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Probability that a text is toxic, by a model that tasks can hold."""
    if not isinstance(model, ToxicityModel):
        raise ValueError("the model's tables are joined: use score_texts")

    known = WordValues()  # each task unpacks one of its own

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts, known))

    return score(text)
