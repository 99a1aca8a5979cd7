"""Text queries against their SQL statements, and against brute force where SQL has none."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import compare
import pytest
import xxhash

import __spark_entry__ as registry
import corpus_pipeline
from effortlens.llm import oracle, queries, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes_of(texts):
    """Least id of each id's class, by comparing all pairs that share a shingle."""
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    sets = {d: shingle_set(t) for d, t in texts.items()}
    holders, equal = defaultdict(list), defaultdict(list)
    for d, s in sets.items():
        equal[texts[d]].append(d)
        for g in s:
            holders[g].append(d)
    for group in equal.values():
        if texts[group[0]] is not None:
            for d in group[1:]:
                join(group[0], d)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            join(a, b)
    return {d: root(d) for d in texts}


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [r.asDict() for r in queries.table(spark, sf_dir, "documents").collect()]


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.all_queries()}
    assert set(registry.queries()) >= {*queries.all_queries(), "pipeline"}


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_query_matches_statement(spark, sf_dir, name):
    result = registry.queries()[name](spark, sf_dir)
    assert compare.difference(result, compare.connect(sf_dir), oracle.STATEMENTS[name]) is None


def test_shards_hold_all_documents(spark, sf_dir, documents):
    rows = queries.op1_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in documents)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(8))


def test_shards_sizes_and_digests_match_brute_force(spark, sf_dir, documents):
    def shard(doc_id, shards):
        bids = []
        for s in range(shards):
            code = 42
            for value, form in ((sharding.SEED, "<i"), (s, "<i"), (doc_id, "<q")):
                code = xxhash.xxh64_intdigest(struct.pack(form, value), code)
            bids.append((code - (code >> 63 << 64), s))
        return max(bids)[1]

    want = []
    for d in documents:
        raw = (d["text"] or "").encode()
        want.append((d["doc_id"], len(raw) + 1, zlib.crc32(raw), "key", shard(d["doc_id"], 8), shard(d["doc_id"], 9)))
    got = queries.op1_sharding(spark, sf_dir).drop("slot").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_near_duplicates_match_brute_force(spark, sf_dir, documents):
    want = classes_of({d["doc_id"]: d["text"] for d in documents})
    got = {r.doc_id: r.class_id for r in queries.op5_minhash_near_dedup(spark, sf_dir).collect()}
    assert got == want


def test_packing_is_a_partition_of_all_tokens(spark, sf_dir, documents):
    rows = queries.op3_best_fit_packing(spark, sf_dir).collect()
    tokens = {d["doc_id"]: len((d["text"] or "").split()) for d in documents}
    got, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        assert r.start == got[r.doc_id] or r.piece > 0
        got[r.doc_id] += r.n_tokens
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    assert dict(got) == tokens
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in held:
            assert r.bin_offset == at
            at += r.n_tokens
        assert at <= held[0].capacity and len({r.capacity for r in held}) == 1


def test_quality_keeps_good_rows_and_rejects_bad_ones(spark, sf_dir):
    labels = {r.doc_id: r for r in queries.table(spark, sf_dir, "labels").collect()}
    rows = queries.op6_quality(spark, sf_dir).collect()
    assert len(rows) == queries.table(spark, sf_dir, "documents").count()
    right = [r.keep == (labels[r.doc_id].quality == 1) for r in rows if r.doc_id in labels]
    assert sum(right) >= 0.95 * len(right)


def test_toxicity_ranks_toxic_rows_first(spark, sf_dir):
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf_dir, "labels").collect()}
    rows = queries.op8_toxicity(spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    toxic = [r.score for r in rows if labels.get(r.doc_id) == 1]
    other = [r.score for r in rows if labels.get(r.doc_id) == 0]
    pairs = [(a > b) + (a == b) / 2 for a in toxic for b in other]
    assert sum(pairs) / len(pairs) > 0.75


def test_base_spans_match_plain_patterns(spark, sf_dir, documents):
    from test_llm_pii import plain_spans

    rows = {r.doc_id: r for r in queries.op7_pii(spark, sf_dir).collect()}
    for d in documents:
        spans = plain_spans(d["text"])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        row = rows[d["doc_id"]]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.n_email == sum(k == "email" for k, _, _ in spans)


def test_stages_of_the_pipeline(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = queries.table(spark, sf_dir, "documents")
    kept = {r.doc_id for r in queries.op6_quality(spark, sf_dir).collect() if r.keep}
    texts = {
        r.doc_id: r.text
        for r in registry.queries()["op9_line_dedup"](spark, sf_dir).collect()
    }
    found = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, sf_dir)
        assert found.columns == docs.columns
        rows = {r.doc_id: r.text for r in found.collect()}
        if name == "quality":
            assert set(rows) == kept
        elif name == "line_dedup":
            assert set(rows) == kept and len(texts) == docs.count()
            cleaned = rows
        elif name == "near_dedup":
            best = classes_of(cleaned)
            assert set(rows) == set(best.values())
            assert all(cleaned[d] == t for d, t in rows.items())
            single = rows
        else:
            items = [words(r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]
            clean = {d for d, t in single.items() if not is_contaminated(words(t), items)}
            assert set(rows) == clean
    packed = registry.queries()["pipeline"](spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == clean


def is_contaminated(doc, items):
    windows = {
        tuple(i[p : p + min(13, len(i))]) for i in items if i for p in range(max(1, len(i) - 12))
    }
    hit = set()
    for size in {len(w) for w in windows}:
        for p in range(len(doc) - size + 1):
            if tuple(doc[p : p + size]) in windows:
                hit |= set(range(p, p + size))
    return bool(hit) and 20 * len(hit) >= len(doc)
