"""Texts go through Python once per pass, in arrays that follow a slice's size closely."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from effortlens.llm import decontam, quality
from effortlens.llm.words import SLICE_BYTES

DOCS = [(i, f"text {i} of some more words. " * (i % 4), f"host {i % 2}", "en") for i in range(40)]
LABELS = [(i, int(i % 3 > 0)) for i in range(0, 40, 2)]


def _python_nodes(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def _docs(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


def _labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int")


def test_filter_quality_rates_a_text_once_in_its_last_pass(spark, tmp_path):
    kept = quality.filter_quality(_docs(spark, tmp_path), _labels(spark))
    assert _python_nodes(kept) == 1


def test_score_quality_rates_a_text_once_whatever_is_filtered(spark, tmp_path):
    scored = quality.score_quality(_docs(spark, tmp_path), _labels(spark))
    assert _python_nodes(scored.filter("evidence > 0 and score > 0.5")) == 1
    assert scored.count() == len(DOCS)


def test_item_grams_reads_an_item_once(spark, tmp_path):
    items = [("a", " ".join(f"w{i}" for i in range(30))), ("b", "only three words"), (None, "x y")]
    items += [("c", None), ("d", "")]
    rows = spark.createDataFrame(items, "item_id string, text string")
    rows.write.parquet(f"{tmp_path}/items")
    grams = decontam.item_grams(spark.read.parquet(f"{tmp_path}/items"))
    assert _python_nodes(grams) == 1
    found = grams.select("item_id", "kind").distinct().collect()
    assert {tuple(r) for r in found} == {("a", 0), ("b", 3)}


def test_features_hold_one_kind_of_byte_at_a_time():
    draw = random.Random(5)
    words = ["of", "Words", "1234", "a.", "longer", "x=y", "tab\t"]
    texts = pa.array([" ".join(draw.choices(words, k=3000)) for _ in range(100)])
    assert pa.compute.sum(pa.compute.binary_length(texts)).as_py() > SLICE_BYTES
    quality.features(texts)
    tracemalloc.start()
    try:
        x = quality.features(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50 * SLICE_BYTES
    plain = np.concatenate([quality.features(texts.slice(i, 1)) for i in range(len(texts))])
    assert np.array_equal(x, plain)
    text = texts[7].as_py()
    shares = [sum(map(f, text)) / len(text) for f in (str.islower, str.isupper, str.isdigit)]
    assert np.allclose(x[7, 1:4], shares)
