"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import gzip
import hashlib
import io
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from effortlens.llm import (
    components,
    decontam,
    lines,
    neardup,
    packing,
    quality,
    sharding,
    topk,
    toxicity,
    warc,
)
from effortlens.llm.storage import shared_folder
from effortlens.llm.words import slices

LONG = " ".join(f"w{i}" for i in range(30_000))
# Rows with nulls, repeats, and columns named like those that operators add.
ROWS = [
    (1, "one two three four five six\nfooter", "h", "en", 7),
    (1, "one two three four five six\nfooter", "h", "en", 7),
    (2, "one two three four five six\nfooter", "h", None, 7),
    (3, None, None, "en", None),
    (4, "", "h", "en", None),
    (5, LONG, "h", "en", 1),
    (None, "seven eight nine", None, None, 1),
    (6, " \n ", "g", "en", 1),
    (7, "footer\nother words entirely here", "h", "en", 1),
]
SCHEMA = "doc_id long, text string, source string, lang string, shard int"


@pytest.fixture(scope="module")
def docs(spark):
    extra = ["slot", "row", "k1", "label", "score", "lines", "class_id", "bucket", "vid", "spans"]
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.select("*", *[F.lit("mine").alias(c) for c in extra])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_scratch_goes_where_the_cluster_says(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark).startswith(named or spark.conf.get("spark.sql.warehouse.dir"))


def test_sharding(docs):
    rows = sharding.shard_records(docs, 3, bucket_bytes=20).collect()
    assert len(rows) == len(ROWS)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 3) and r["class_id"] == "mine"
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    again = sharding.shard_records(docs.repartition(5), 3, bucket_bytes=20).collect()
    assert {(r.doc_id, r.text, r.shard) for r in rows} == {(r.doc_id, r.text, r.shard) for r in again}
    assert sharding.shard_records(docs.limit(0), 3).count() == 0


def test_written_shards(docs, tmp_path):
    sharding.write_shards(sharding.shard_records(docs.select("doc_id", "text"), 2), str(tmp_path / "s"))
    assert docs.sparkSession.read.parquet(str(tmp_path / "s")).count() == len(ROWS)


def test_line_dedup(docs):
    out = lines.dedup_lines(docs, ratio=0.5)
    assert out.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text) for r in out.collect() if r.text is not None)
    assert (1, "one two three four five six") in texts and (7, "other words entirely here") in texts
    assert (4, "") in texts and (6, " \n ") in texts and (5, LONG) in texts
    assert out.count() == len(ROWS) and lines.dedup_lines(docs.limit(0)).count() == 0


def test_near_duplicates(docs):
    rows = neardup.near_duplicates(docs).collect()
    classes = {(r.doc_id, r.class_id) for r in rows}
    assert len(rows) == len(ROWS)
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (None, None)} == classes
    kept = neardup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]
    assert neardup.dedup(docs.limit(0)).count() == 0


def test_near_duplicates_by_counts(spark):
    spam = "buy now " * 200
    rows = [(1, spam + "first ending of this text"), (2, spam + "a wholly different close")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    alike = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame, counted=True).collect()}
    apart = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}
    assert alike == {1: 1, 2: 1} and apart == {1: 1, 2: 2}


@pytest.mark.parametrize("with_base", [True, False])
def test_large_groups_of_near_copies_match_brute_force(spark, with_base):
    """Copies of one text, each edited in two places: near it, mostly not near each other."""
    from test_llm_queries import classes_of

    base = [f"x{i}" for i in range(120)]

    def copy(n):
        text = list(base)
        text[n % 120] = f"y{n}"
        text[(n * 7 + 60) % 120] = f"z{n}"
        return " ".join(text)

    rows = [(n, copy(n)) for n in range(1, 200)] + [(999, " ".join(base))] * with_base
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.class_id for r in found.collect()}
    assert got == classes_of(dict(rows))
    assert (len(set(got.values())) == 1) == with_base


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, n) for n in range(101, 120)] + [(7, 7), (5, 4)]
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.vertex: r.label for r in got} == {
        **{i: 0 for i in range(41)},
        **{n: 100 for n in range(100, 120)},
    }
    none = spark.createDataFrame([], "u long, v long")
    assert components.components(none).count() == 0


@pytest.mark.parametrize("path", [(1, 3, 4, 5, 2), (1, 5, 3, 4, 2), (8, 4, 7, 5, 6, 1, 3, 2)])
def test_components_of_shuffled_paths(spark, path):
    """In a small table of edges no other component forces further steps."""
    edges = spark.createDataFrame(list(zip(path, path[1:])), "u long, v long")
    got = components.components(edges).collect()
    assert sorted((r.vertex, r.label) for r in got) == [(v, 1) for v in sorted(path)]


def test_quality(docs, labels):
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    out = quality.filter_quality(docs, labels.limit(0))
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 1, 2, 5, 7]
    assert quality.filter_quality(docs.limit(0), labels).count() == 0


def test_site_posteriors_shrink_sparse_sites(spark):
    rows = [(i, "word " * 30, "big", "p") for i in range(200)] + [(900, "word " * 30, "small", "p")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    model = quality.DocumentModel.fit(*_shapes())
    sites = {r.host: r for r in quality.site_posteriors(frame, model).collect()}
    alone = 1 / (1 + 2.718281828 ** -model.evidence(_array("word " * 30))[0])
    assert abs(sites["big"].path_quality - alone) < 1e-6
    assert abs(sites["small"].path_quality - alone) < 1e-6


def _array(*texts):
    import pyarrow as pa

    return pa.array(texts)


def _shapes():
    import numpy as np

    texts = ["plain words in a row here", "OUT!! LOUD!! CAPS!!", "more plain words then", "X!! Y!!"]
    return quality.features(_array(*texts)), np.array([1.0, 0.0, 1.0, 0.0])


def test_toxicity(docs, labels):
    for known in (labels, labels.limit(0)):
        model = toxicity.fit_toxicity(docs, known)
        rows = docs.select("doc_id", toxicity.toxicity_score(model, F.col("text")).alias("s")).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.s <= 1 for r in rows)
    empty = toxicity.fit_toxicity(docs.limit(0), labels)
    assert docs.limit(0).select(toxicity.toxicity_score(empty, F.col("text"))).count() == 0


def test_toxicity_beyond_what_tasks_hold(spark, monkeypatch):
    """Count tables of more than MAX_GRAMS are joined, and no gram is cut."""
    rows = [(i, f"plain word{i} here é{i % 7} and and", 0) for i in range(60)]
    rows += [(100 + i, f"vile{i % 5} scum word{i} you", 1) for i in range(60)]
    rows += [(300, None, 0), (301, " ", 1), (1, "plain word1 here é1 and and", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scores = []
    for most in (toxicity.MAX_GRAMS, 10):
        monkeypatch.setattr(toxicity, "MAX_GRAMS", most)
        model = toxicity.fit_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
        scored = toxicity.score_texts(model, frame).collect()
        scores.append(sorted((r.doc_id, r.score) for r in scored))
    assert isinstance(model, toxicity.JoinedModel) and len(scores[1]) == len(rows)
    assert len({round(s, 6) for _, s in scores[0]}) > 20
    assert [d for d, _ in scores[0]] == [d for d, _ in scores[1]]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(*scores))


def test_toxicity_counts_all_labelled_rows(spark):
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("aa").alias("text"))
    labels = frame.select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.fit_toxicity(frame, labels).toxic.n.sum() > 3 * 2000


def test_decontamination(spark, docs):
    items = [(1, "one two three four five six"), (2, None), (None, "seven eight nine"), (3, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {r.doc_id: r for r in decontam.contamination(docs, bench).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1]["items"]) == (7, 6, ["1"])
    assert (rows[3].n_words, rows[3].n_hit, rows[None].n_hit) == (0, 0, 0)
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 3, 4, 5, 6, 7]
    assert decontam.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


def test_decontamination_extends_and_merges_hits(spark):
    item = " ".join(f"i{n}" for n in range(30))
    hit = " ".join(f"i{n}" for n in range(5, 25))
    rows = [(1, f"a b {hit} c"), (2, " ".join(f"i{n}" for n in range(12))), (3, f"{item} {item}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (8, item), (7, "tail")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontam.contamination(frame, bench).collect()}
    assert got == {1: (20, ["8", "9"]), 2: (0, []), 3: (60, ["8", "9"])}


def test_packing(docs):
    rows = packing.pack(docs, capacities=(4, 8, 64), group_pieces=50).collect()
    assert sum(r.n_tokens for r in rows) == sum(len((r[1] or "").split()) for r in ROWS)
    assert sum(r.bin_id is None for r in rows) == 3
    assert {r.capacity for r in rows if r.bin_id is not None} <= {4, 8, 64}
    assert packing.pack(docs.limit(0)).count() == 0


def test_sequences_hold_the_tokens(spark):
    frame = spark.createDataFrame([(1, "a b c d e"), (2, "f g"), (3, " h ")], "doc_id long, text string")
    packed = packing.pack(frame, capacities=(2, 4))
    texts = packing.sequences(frame, packed).collect()
    assert sorted(" ".join(r.text for r in texts).split()) == list("abcdefgh")
    assert all(len(r.text.split()) <= r.capacity for r in texts)


PAGES = [
    (1, "http://a b\n/x", "p" * 1500),
    (5, "u", "p" * 1500),
    (3, None, "p" * 1500),
    (None, "u", "p" * 1500),
    (8, "u", "short"),
    (9, "u", "short"),
    (10, "u", None),
    (11, "u", "é😀" * 400_000),
]


def test_warc_round_trip(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.archive(frame, file_bytes=2000).collect()
    by_id = {r.record_id: r for r in rows}
    assert len(rows) == len(PAGES)
    for i, _, html in PAGES:
        payload = (html or "").encode()
        assert by_id[i].payload_bytes == len(payload)
        assert by_id[i].payload_digest == hashlib.sha1(payload).hexdigest()
    assert {i: by_id[i].refers_to for i in by_id} == {
        1: 5, 3: 5, None: 5, 5: None, 8: None, 9: None, 10: None, 11: None,
    }
    assert warc.archive(frame.limit(0)).count() == 0


def test_warc_reader_refuses_damage():
    good = warc.record_bytes(1, "u", b"hello", hashlib.sha1(b"hello").hexdigest(), None)
    packed = gzip.compress(good)
    assert [r[0] for r in warc.read_records(io.BytesIO(packed + packed))] == [1, 1]
    for bad in (packed[:-9], gzip.compress(good.replace(b"hello", b"hellO")), gzip.compress(good[:-1])):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(bad)))


def test_top_k(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [None, 1.0]), (None, [9.0, 9.0]), (7, [1.0, 0.0]), (8, [-1.0]), (100, [0.0, 2.0]), (9, []),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = topk.exact_top_k(frame, F.col("vec_id") % 100 == 0, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 1024**2), (0, 2, 7, 1024**2), (0, 3, 2, 1024 * 512),
        (100, 1, 2, 2048 * 512), (100, 2, 0, 0), (100, 3, 1, 0),
    ]
    assert topk.exact_top_k(frame.limit(0), F.lit(True)).count() == 0


def test_top_k_over_many_blocks_and_groups(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    data = np.concatenate([rng.normal(c, 0.05, (200, 4)) for c in (-0.5, 0.1, 0.6)] + [np.ones((300, 4))])
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.exact_top_k(frame, F.col("vec_id") % 50 == 0, 5, block_rows=60, query_rows=4).collect()
    whole = np.floor(1024 * data).astype(np.int64)
    want = []
    for q in range(0, len(data), 50):
        order = sorted((-int(whole[q] @ d), i) for i, d in enumerate(whole) if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(order, 1)]
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_no_file_is_left_in_the_repository():
    assert not list(Path(warc.__file__).parent.glob("*.gz"))


def test_id_map_keeps_all_listed_rows(spark):
    from effortlens.llm.idmap import maybe_among

    rows = spark.range(20000).withColumn("x", F.lit(1)).unionByName(
        spark.createDataFrame([(None, 2)], "id long, x int")
    )
    ids = spark.range(0, 20000, 40).select(F.col("id").cast("int").alias("k"))
    got = {r.id for r in maybe_among(rows, "id", ids).collect()}
    assert set(range(0, 20000, 40)) <= got and len(got) < 600 and None not in got
    assert maybe_among(rows, "id", ids.limit(0)).count() == 0


def test_toxicity_rates_words_alike_whatever_a_task_remembers(monkeypatch):
    rng = np.random.default_rng(3)
    texts = _array(*[" ".join(f"w{n}" for n in rng.integers(0, 40, 12)) for _ in range(50)])
    counts = [toxicity.Table(*_grams_of(f"w{i} w{i + 7} vile{i}")) for i in (1, 2, 3)]
    model = toxicity.ToxicityModel(*counts)
    plain = np.concatenate([model.features(texts.slice(i, 1)) for i in range(50)])
    for most in (toxicity.KEPT_WORDS, 5):
        monkeypatch.setattr(toxicity, "KEPT_WORDS", most)
        known = toxicity.WordValues()
        kept = np.concatenate([model.features(texts.slice(i, 10), known) for i in range(0, 50, 10)])
        assert np.array_equal(plain, kept) and len(set(plain[:, 0])) > 20


@pytest.mark.parametrize("counted", [False, True])
def test_families_of_mostly_unlike_copies_match_brute_force(spark, counted):
    """Copies with any number of edits, copies of these, and edits that many copies share."""
    from test_llm_queries import classes_of

    draw = random.Random(11)
    base = [f"x{i}" for i in range(150)]
    texts = [base]
    for n in range(1, 400):
        text = list(draw.choice(texts) if n % 4 == 0 else base)
        for _ in range(draw.choice((1, 4, 6, 7, 8, 9, 12))):
            at = draw.randrange(len(text))
            new = f"y{draw.randrange(4)}" if n % 3 == 0 else f"z{n}.{at}"
            text[at : at + draw.randrange(3)] = [new]
        texts.append(text)
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame, counted=counted).collect()}
    assert got == classes_of(dict(rows))
    assert 20 < len(set(got.values())) < 380


def test_sketches_differ_in_no_more_places_than_sets():
    import pyarrow as pa

    draw = np.random.default_rng(3)
    pool = draw.integers(-(1 << 63), (1 << 63) - 1, 4000)
    sets = [set(draw.choice(pool, n, replace=False).tolist()) for n in draw.integers(0, 3000, 40)]
    sets.append(sets[0] ^ set(pool[:5].tolist()))
    bits = np.array(neardup.odd_sketches(pa.array([list(s) for s in sets], pa.list_(pa.int64()))).to_pylist())
    assert bits.shape == (41, neardup.SKETCH_WORDS)
    for x, a in zip(bits, sets, strict=True):
        for y, b in zip(bits, sets, strict=True):
            differ = np.bitwise_count((x ^ y).view(np.uint64)).sum()
            assert differ <= len(a ^ b) and (differ == 5 or len(a ^ b) != 5)


def _grams_of(text):
    words = next(slices(_array(text)))[2]
    grams = toxicity.Grams(words, np.arange(len(words.start)))
    gram, context = grams.longest()
    code, at, n = np.unique(gram[grams.event], return_index=True, return_counts=True)
    return code, context[grams.event][at], n


def test_texts_of_one_id_are_one_class_with_all_links(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (2, b), (2, b + " z"), (3, a + " z"), (2, b), (9, b + " y"), (8, "other words here")]
    rows += [(5, a + " q"), (5, "c d e f g h"), (6, "c d e f g h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.class_id) for r in neardup.near_duplicates(frame).collect()}
    assert found == {(1, 1), (3, 1), (5, 1), (6, 1), (2, 2), (9, 2), (8, 8)}
    joined = frame.unionByName(spark.createDataFrame([(2, a)], frame.schema))
    found = {(r.doc_id, r.class_id) for r in neardup.near_duplicates(joined).collect()}
    assert found == {(i, 1) for i in (1, 2, 3, 5, 6, 9)} | {(8, 8)}
    assert {r.doc_id for r in neardup.dedup(joined).collect()} == {1, 8}


def test_sharding_takes_any_column_name(spark):
    frame = spark.createDataFrame([(i, "t", i) for i in range(9)], "doc_id long, text string, `a.b c` int")
    rows = sharding.shard_records(frame, 2).collect()
    assert sorted(r["a.b c"] for r in rows) == list(range(9))


def test_archives_are_read_by_as_many_tasks_as_files(spark, tmp_path):
    rows = [(i, f"http://h/{i}", chr(65 + i) * 3000) for i in range(8)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    made = warc.write_warc(frame, str(tmp_path / "w"), file_bytes=1)
    read = warc.read_warc(spark, str(tmp_path / "w"))
    assert read.rdd.getNumPartitions() == made.count() > 4 and read.count() == 8


def test_top_k_stops_where_scores_might_pass_a_long(spark):
    for big in (1e300, -1e300, 1e7 * 1024):
        frame = spark.createDataFrame([(0, [big, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(OverflowError):
            topk.exact_top_k(frame, F.lit(True), 1)
