"""Benchmark decontamination by winnowing.

A text's fingerprints are the hashes of its 5-word grams that are smallest (the last one, on
ties) in some run of 9 consecutive grams. Any run of 13 words that a document shares with an
item is such a run, so both sides keep the same gram of it at the same place: every shared
span of 13 words or more is found. Fingerprints are joined, each hit is checked word by word
and extended as far as the words agree, at most 8 words either way; a hit counts where the
agreeing run has 13 words or more. An item of fewer than 13 words is one window, found by the
hash of all its words among the document's grams of that size.

Only fingerprints that a bit map of the benchmark's fingerprints knows leave the scan of the
documents. The map has a fixed size whatever the benchmark holds and no false negatives: a
fuller map lets more through, and the join decides. Results are by text, so copies of a text
are matched once; ids need not be unique.

Defined results: a null, empty or wordless text has no words, no hits and is clean; items
without words or id take no part; repeated documents get equal rows; repeated items count
once; an empty benchmark leaves all documents clean; other columns are not read, and the
filter returns the columns it was given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.llm.storage import written
from effortlens.llm.words import Words, ngrams, slices

GRAM = 5
WINDOW = 13
MAP_BITS = 23

_GRAMS = "array<struct<kind int, code long, pos int, gram array<string>, before array<string>, after array<string>>>"
_BITS_PER_ROW = 1 << 15


def winnow(words: Words, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the kept grams and the index of their first word."""
    code, at = ngrams(words, gram)
    run = window - gram + 1
    count = len(code) - run + 1
    if count <= 0:
        return code[:0], at[:0]
    least, which = code[:count].copy(), np.zeros(count, np.int64)
    for j in range(1, run):
        other = code[j : j + count]
        lower = other <= least
        least[lower] = other[lower]
        which[lower] = j
    text = words.text[at]
    inside = text[:count] == text[run - 1 :]
    kept = np.zeros(len(code), bool)
    kept[(np.arange(count) + which)[inside]] = True
    return code[kept], at[kept]


def _grams_of(words: Words, kinds: list[int], known: np.ndarray | None) -> list[list[dict]]:
    """For each text its kept grams of all kinds: 0 winnowed, else all grams of that size."""
    out: list[list[dict]] = [[] for _ in range(len(words))]
    text = words.text
    for kind in kinds:
        code, at = winnow(words) if kind == 0 else ngrams(words, kind)
        if known is not None:
            place = code & np.uint64((1 << MAP_BITS) - 1)
            hit = (known[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
            code, at = code[hit == 1], at[hit == 1]
        size, reach = (GRAM, WINDOW - GRAM) if kind == 0 else (kind, 0)
        for c, i in zip(code.astype(np.int64).tolist(), at.tolist(), strict=True):
            t = text[i]
            lo, hi = int(words.first[t]), int(words.first[t + 1])
            out[t].append(
                {
                    "kind": kind,
                    "code": c,
                    "pos": i - lo,
                    "gram": [words.word(j) for j in range(i, i + size)],
                    "before": [words.word(j) for j in range(i - 1, max(lo, i - reach) - 1, -1)],
                    "after": [words.word(j) for j in range(i + size, min(hi, i + size + reach))],
                }
            )
    return out


_ARROW_GRAMS = pa.list_(
    pa.struct(
        [
            ("kind", pa.int32()),
            ("code", pa.int64()),
            ("pos", pa.int32()),
            ("gram", pa.list_(pa.string())),
            ("before", pa.list_(pa.string())),
            ("after", pa.list_(pa.string())),
        ]
    )
)


def item_grams(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id`` and a column for each field of the item's grams."""

    @F.arrow_udf(_GRAMS)
    def grams(texts: pa.Array) -> pa.Array:
        found = []
        for _, _, words in slices(texts):
            long = _grams_of(words, [0], None)
            for t, n in enumerate(words.counts.tolist()):
                if 0 < n < WINDOW:
                    row = [words.word(i) for i in range(words.first[t], words.first[t + 1])]
                    one = next(slices(pa.array([" ".join(row)])))[2]
                    long[t] = _grams_of(one, [n], None)[0]
            found += long
        return pa.array(found, _ARROW_GRAMS)

    named = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    # Marked so, the function is not evaluated again for the filter that Spark infers of inline.
    once = grams.asNondeterministic()
    found = named.filter("item_id is not null").select("item_id", once("text").alias("grams"))
    return found.select("item_id", F.inline("grams"))


def bit_map(grams: DataFrame) -> np.ndarray:
    """Bits of all codes, 2**MAP_BITS of them: at most 256 rows of 4 KiB reach the driver."""
    place = F.col("code").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = (
        grams.select(
            F.shiftright(place, 15).cast("int").alias("part"), (place % _BITS_PER_ROW).alias("bit")
        )
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for r in rows:
        start = r["part"] * _BITS_PER_ROW // 8
        bits[start : start + _BITS_PER_ROW // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text; null is told from empty."""
    some = F.coalesce(text, F.lit(""))
    return (
        F.xxhash64(some, text.isNull()).alias("k1"),
        F.xxhash64(F.lit(7), some, F.length(some)).alias("k2"),
    )


def _agreeing(a: str, b: str) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """For each row: ``doc_id``, text key ``k1, k2``, ``n_words``, ``n_hit`` and ``items``."""
    known = written(item_grams(items, item_id, item_text), "item-grams")
    kinds = [r["kind"] for r in known.select("kind").distinct().collect()]  # 13 at most
    bits = bit_map(known)

    @F.arrow_udf(f"n_words long, grams {_GRAMS}")
    def scan(texts: pa.Array) -> pa.Array:
        counts, found = [], []
        for _, _, words in slices(texts):
            counts += words.counts.tolist()
            found += _grams_of(words, kinds, bits)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(found, _ARROW_GRAMS)], ["n_words", "grams"]
        )

    scanned = written(
        docs.select(
            F.col(doc_id).alias("doc_id"), *_text_key(F.col(text)), scan(F.col(text)).alias("s")
        ).select("doc_id", "k1", "k2", "s.n_words", "s.grams"),
        "document-grams",
    )
    texts = (
        scanned.filter(F.size("grams") > 0).groupBy("k1", "k2").agg(F.first("grams").alias("grams"))
    )
    item = known.select(
        "kind",
        "code",
        F.col("item_id"),
        F.col("gram").alias("item_gram"),
        F.col("before").alias("item_before"),
        F.col("after").alias("item_after"),
    )
    hits = (
        texts.select("k1", "k2", F.inline("grams"))
        .join(item, ["kind", "code"])
        .filter(F.col("gram") == F.col("item_gram"))
        .withColumn("left", _agreeing("before", "item_before"))
        .withColumn("right", _agreeing("after", "item_after"))
        .filter((F.col("kind") > 0) | (F.col("left") + F.col("right") + GRAM >= WINDOW))
        .select(
            "k1",
            "k2",
            "item_id",
            (F.col("pos") - F.col("left")).alias("start"),
            (F.col("pos") + F.size("gram") + F.col("right")).alias("stop"),
        )
    )
    # A text has no more spans than words, and no more items than the benchmark.
    found = hits.groupBy("k1", "k2").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    union = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto")),
        lambda done, s: F.struct(
            (
                done["hit"]
                + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], done["upto"]))
            ).alias("hit"),
            F.greatest(done["upto"], s["stop"]).alias("upto"),
        ),
    )["hit"]
    summed = written(found.select("k1", "k2", union.alias("n_hit"), "items"), "contaminated-texts")
    return (
        scanned.drop("grams")
        .join(summed, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "k1",
            "k2",
            "n_words",
            F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The clean rows, with the columns they came with."""
    text = names.get("text", "text")
    bad = written(
        contamination(docs, items, **names).filter(is_contaminated()).select("k1", "k2").distinct(),
        "contaminated-keys",
    )
    rows = docs.select(F.struct("*").alias("row"), *_text_key(F.col(text)))
    return rows.join(bad, ["k1", "k2"], "left_anti").select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
