"""MinHash near-dedup with DartMinHash signatures and a banded join.

Documents are near-duplicates where the Jaccard similarity of their sets of 5-word shingles
(or, with ``counted``, of the multisets) is at least 0.8.

Signatures: each shingle owns a region of weight times rank, cut into unit cells. A hash of
the cell says how many darts land in it (Poisson with mean 1), and a hash of each dart its
weight, rank and coordinate. A document scans its shingles' cells in order of rank until every
coordinate has a dart, and keeps the earliest per coordinate, so the work is about
shingles + k ln k darts instead of shingles times k, and two documents agree in a coordinate
with probability equal to their weighted Jaccard similarity.

Links: equal texts are grouped first and only their least id goes on. Bands of equal
coordinates make buckets. Round one checks each bucket member against the bucket's most
central one, which shares most buckets with others (the text that copies were made from, as
a rule); components of the links found leave most buckets with one class. Members of the other
buckets are peeled: shingles that no other member left has cannot be common to two of them, so a
text with too few others is similar to none and goes, which leaves more shingles alone in turn.
In every further round some members of a bucket lead, and all its members of other classes are
checked against them; only members outside the bucket's largest class need to lead, each once.
A round takes as many as keep its comparisons below ``PAIRS`` times the members that the corpus
has in buckets, drawn by hash, so no round makes all pairs of a bucket, whatever it holds.
When none is left to lead, two members of different classes have been compared, as one of them
has led, or are apart for sure. Three bounds rule pairs out while they are joined, and none of
them a pair that is similar enough: Jaccard distance is a metric, and their distances from the
bucket's first leader, all measured in round one, differ by more than 0.2; the shingles that
the two share with anyone are too few; or odd sketches (bits saying whether a slot holds an odd
number of shingles) differ in more places than their sets may.
Similarities are exact, from the full shingle sets of bucket members only.

Defined results: ``class_id`` is the least doc_id of the class. Texts that are equal, also
when empty, are one class; a text without words is near no other text; fewer than 5 words make
one shingle. A null text or a null doc_id is a class of its own. Rows that share a doc_id are
one document: all texts that an id has are one class, with the links of each of them (doc_ids
near 2**63 are taken by such texts). Other columns are not read; ``dedup`` returns the columns it was given, one row
per class.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.llm.components import components
from effortlens.llm.storage import written
from effortlens.llm.words import mix, shingles, slices

SHINGLE = 5
SIGNED_TEXTS = 512
SIMILARITY = 0.8
BANDS = 28
ROWS = 5
LEADERS = 16  # of a bucket in one round, about, at least
PAIRS = 32  # comparisons of a round per bucket member of the corpus, beyond LEADERS each
PEELED = 0.05  # share of the members that a pass of peeling must remove for another one
SKETCH_WORDS = 16  # longs of an odd sketch: texts of up to some 2,000 words are told apart
SEED = 0x5EED

_U = np.uint64
_LAST = _U(0xFFFFFFFFFFFFFFFF)


def _poisson_steps() -> np.ndarray:
    """Hash values at which a cell's number of darts goes up by one."""
    total, term, steps = 0.0, math.exp(-1.0), []
    for n in range(1, 18):
        total += term
        steps.append(_U(min(int(total * 2.0**64), 2**64 - 1)))
        term /= n
    return np.array(steps, np.uint64)


_STEPS = _poisson_steps()


def _within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the owner, and 0, 1, ... inside it, for ``counts`` things of each owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def dart_minhash(
    element: np.ndarray,
    weight: np.ndarray | None,
    owner: np.ndarray,
    owners: int,
    k: int,
    seed: int = SEED,
) -> np.ndarray:
    """Signatures (``owners`` x ``k``) of weighted sets; a set without elements has all 0.

    ``element`` are hashes, ``owner`` the set of each. Without ``weight`` all weigh 1, and a
    repeated element changes nothing.
    """
    mass = np.bincount(owner, weights=weight, minlength=owners)
    units = None if weight is None else np.ceil(weight).astype(np.int64)
    earliest = np.full(owners * k, _LAST)
    signature = np.zeros(owners * k, np.uint64)
    enough = k * (math.log(k) + 2)
    low = np.zeros(owners, np.int64)
    step = np.ceil(enough / np.maximum(mass, 1e-9)).clip(1, 1 << 20).astype(np.int64)
    open_sets = mass > 0
    while open_sets.any():
        mine = np.flatnonzero(open_sets[owner])
        slabs = step[owner[mine]]
        cell, place = _within(slabs if units is None else slabs * units[mine])
        of = mine[cell]
        rank = low[owner[of]] + (place if units is None else place % slabs[cell])
        code = element[of] + mix(rank.astype(np.uint64) + _U(seed))
        if units is not None:
            unit = place // slabs[cell]
            code = mix(code) + mix(unit.astype(np.uint64) + _U(seed + 1))
        code = mix(code)
        dart, number = _within(np.searchsorted(_STEPS, code, "right"))
        dart_code = mix(code[dart] + (number.astype(np.uint64) + _U(1)) * _U(0xA24BAED4963EE407))
        if units is not None:
            at = unit[dart] + (mix(dart_code) >> _U(11)).astype(np.float64) * 2.0**-53
            inside = at < weight[of[dart]]
            dart, dart_code = dart[inside], dart_code[inside]
        key = owner[of[dart]] * k + (dart_code % _U(k)).astype(np.int64)
        when = (rank[dart].astype(np.uint64) << _U(40)) | (dart_code >> _U(24))
        np.minimum.at(earliest, key, when)
        first = earliest[key] == when
        signature[key[first]] = dart_code[first]
        low += np.where(open_sets, step, 0)
        step = (step + 1) // 2
        open_sets &= (earliest.reshape(owners, k) == _LAST).any(1)
    return signature.reshape(owners, k)


def _sorted(code: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct (text, code) begins in their order, and that order."""
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    return np.flatnonzero(new), order


def band_codes(texts: pa.Array, bands: int, rows: int, counted: bool) -> pa.Array:
    """For each text one hash per band; no bands where there are no words."""
    parts = []
    # Darts go with the number of signatures, not with bytes: many short texts need most.
    for at, to, words in slices(texts, most=SIGNED_TEXTS):
        code, text = shingles(words, SHINGLE)
        weight = None
        if counted:
            first, order = _sorted(code, text)
            weight = np.diff(np.append(first, len(order))).astype(float)
            code, text = code[order][first], text[order][first]
        sign = dart_minhash(code, weight, text, to - at, bands * rows)
        sign = sign.reshape(to - at, bands, rows)
        total = mix(np.arange(bands, dtype=np.uint64))[None, :].repeat(to - at, 0)
        for r in range(rows):
            total = mix(total + sign[:, :, r])
        lists = pa.array(list(total.view(np.int64)), pa.list_(pa.int64()))
        parts.append(pc.if_else(pa.array(words.counts > 0), lists, pa.array([[]], lists.type)[0]))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


def shingle_sets(texts: pa.Array, counted: bool) -> pa.Array:
    """For each text the hashes of its distinct shingles; occurrences differ if ``counted``."""
    parts = []
    for at, to, words in slices(texts):
        code, text = shingles(words, SHINGLE)
        first, order = _sorted(code, text)
        if counted:
            _, number = _within(np.diff(np.append(first, len(order))))
            code, text = mix(code[order] + number.astype(np.uint64)), text[order]
        else:
            code, text = code[order][first], text[order][first]
        ends = np.searchsorted(text, np.arange(to - at + 1))
        parts.append(
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code.view(np.int64)))
        )
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


def odd_sketches(sets: pa.Array) -> pa.Array:
    """For each set of hashes ``SKETCH_WORDS`` longs, of bits telling slots of an odd number.

    A slot that differs holds a hash of one of two sets alone, so sets differ in at least as many
    hashes as their sketches differ in bits.
    """
    if isinstance(sets, pa.ChunkedArray):
        sets = sets.combine_chunks()
    bits = 64 * SKETCH_WORDS
    parts = []
    for at in range(0, len(sets), SIGNED_TEXTS):
        some = sets.slice(at, SIGNED_TEXTS)
        counts = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False)
        code = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        slot = np.repeat(np.arange(len(some)), counts) * bits + (mix(code) % _U(bits)).astype(np.int64)
        odd = (np.bincount(slot, minlength=len(some) * bits) & 1).astype(np.uint8)
        words = np.packbits(odd).view(np.int64).reshape(len(some), SKETCH_WORDS)
        parts.append(pa.array(list(words), pa.list_(pa.int64())))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


class _Links:
    """Finds the classes of ``members`` (vid, bucket, degree) with the sets of ``features``.

    ``given`` are links (u, v of vids) that hold from the start.
    """

    def __init__(self, members: DataFrame, features: DataFrame, similarity: float, given: DataFrame):
        self.members, self.features, self.similarity = members, features, similarity
        self.given = given
        self.labels: DataFrame | None = None  # vertex, label of vids in classes of two or more

    def _labelled(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("label", F.col("vid"))
        known = self.labels.withColumnRenamed("label", "known")
        return rows.join(known, rows["vid"] == known["vertex"], "left").select(
            *rows.columns, F.coalesce("known", "vid").alias("label")
        )

    def _merge(self, edges: DataFrame) -> None:
        """Join the classes that the ``edges`` (u, v of labels) connect."""
        if self.labels is not None and edges.isEmpty():
            return
        parts = written(components(edges), "classes")
        if self.labels is None:
            self.labels = parts
            return
        moved = parts.select(F.col("vertex").alias("label"), F.col("label").alias("to"))
        old = self.labels.join(moved, "label", "left").select(
            "vertex", F.coalesce("to", "label").alias("label")
        )
        new = parts.join(self.labels.select("vertex"), "vertex", "left_anti")
        self.labels = written(old.unionByName(new), "classes")

    def _measured(self, pairs: DataFrame) -> DataFrame:
        """Pairs (u, v and more) with their exact ``similarity``."""
        left = self.features.select(F.col("vid").alias("u"), F.col("shingles").alias("a"))
        right = self.features.select(F.col("vid").alias("v"), F.col("shingles").alias("b"))
        common = F.size(F.array_intersect("a", "b"))
        similarity = common / (F.size("a") + F.size("b") - common)
        both = pairs.join(left, "u").join(right, "v")
        return both.select(*pairs.columns, similarity.alias("similarity"))

    def _first_round(self) -> tuple[DataFrame, DataFrame]:
        """Members with the leader of their bucket, and how similar they are to it."""
        # The most central member, the least id on ties.
        rank = F.struct("degree", (-F.col("vid")).alias("id"))
        leaders = self.members.groupBy("bucket").agg(F.max(rank).alias("best"))
        leaders = written(
            leaders.select("bucket", (-F.col("best.id")).alias("leader")), "leaders"
        )
        led = written(
            self.members.join(leaders, "bucket").select("bucket", "vid", "leader"), "led-members"
        )
        pairs = led.filter("vid <> leader").select(
            F.col("vid").alias("u"), F.col("leader").alias("v")
        )
        measured = written(self._measured(pairs.distinct()), "leader-similarities")
        links = measured.filter(F.col("similarity") >= self.similarity).select("u", "v")
        self._merge(links.unionByName(self.given))
        return led, measured

    def _profiles(self, rows: DataFrame) -> DataFrame:
        """``size`` and ``sketch`` of the set of each vid in ``rows``."""

        @F.arrow_udf("array<long>")
        def sketched(sets: pa.Array) -> pa.Array:
            return odd_sketches(sets)

        ids = rows.select("vid").distinct()
        sets = self.features.join(ids, "vid", "left_semi")
        return written(
            sets.select("vid", F.size("shingles").alias("size"), sketched("shingles").alias("sketch")),
            "profiles",
        )

    def _peeled(self, rows: DataFrame) -> DataFrame:
        """The ``rows`` (bucket, vid, size, ...) that may have a link, with ``shared``.

        ``shared`` counts a text's shingles that another text of the rows has too. A text that
        is similar enough to one of ``size`` b has at least s / (1 + s) * (a + b) in common with
        it, and b is at least s * a and the least size in the bucket. Every pass but the last
        removes a share of the rows, so all passes together read a multiple of the first.
        """
        s, before = self.similarity, rows.count()
        while True:
            ids = rows.select("vid").distinct()
            grams = self.features.join(ids, "vid", "left_semi").select(
                "vid", F.explode("shingles").alias("gram")
            )
            # A shingle of many texts reaches its reducer as one row per task.
            alone = (
                grams.groupBy("gram")
                .agg(F.min("vid").alias("vid"), F.count("*").alias("holders"))
                .filter("holders = 1")
                .groupBy("vid")
                .agg(F.count("*").alias("alone"))
            )
            shared = F.col("size") - F.coalesce("alone", F.lit(0))
            counted = written(
                rows.drop("shared").join(alone, "vid", "left").withColumn("shared", shared).drop("alone"),
                "shared-shingles",
            )
            least = counted.groupBy("bucket").agg(F.min("size").alias("least"))
            other = F.greatest("least", s * F.col("size"))
            enough = F.col("shared") * (1 + s) + 1e-6 >= s * (F.col("size") + other)
            rows = written(counted.join(least, "bucket").filter(enough).drop("least"), "peeled-members")
            left = rows.count()
            if left >= (1 - PEELED) * before:
                return rows
            before = left

    def _mixed_members(self, first: DataFrame, measured: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of buckets of several classes that may have another link, and their profiles."""
        labelled = written(self._labelled(first), "labelled-members")
        several = labelled.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b"))
        rows = labelled.join(several.filter("a < b").select("bucket"), "bucket").drop("label")
        of_leader = measured.select(
            F.col("u").alias("vid"), F.col("v").alias("leader"), "similarity"
        )
        distance = F.when(F.col("vid") == F.col("leader"), 0.0).otherwise(1 - F.col("similarity"))
        rows = rows.join(of_leader, ["vid", "leader"], "left")
        rows = written(rows.select("bucket", "vid", distance.alias("distance")), "mixed-members")
        profiles = self._profiles(rows)
        return self._peeled(rows.join(profiles.drop("sketch"), "vid")), profiles

    def _may_link(self) -> Column:
        """Whether no bound rules out the pair of members ``x`` and ``y``."""
        s = self.similarity
        both = F.col("x.size") + F.col("y.size")
        apart = F.abs(F.col("x.distance") - F.col("y.distance"))
        common = F.least("x.shared", "y.shared") * (1 + s)
        differ = sum(
            F.bit_count(F.get("x.sketch", F.lit(i)).bitwiseXOR(F.get("y.sketch", F.lit(i))))
            for i in range(SKETCH_WORDS)
        )
        return (
            (apart <= 1 - s + 1e-9)
            & (common + 1e-6 >= s * both)
            & (differ * (1 + s) <= (1 - s) * both + 1e-6)
        )

    def run(self) -> DataFrame:
        """``vertex`` and ``label`` of all texts in classes of two or more."""
        first, measured = self._first_round()
        budget = PAIRS * first.count()
        members, profiles = self._mixed_members(first, measured)
        members = members.withColumn("led", F.lit(False))
        for turn in count():
            labelled = written(self._labelled(members), "labelled-members")
            classes = labelled.groupBy("bucket", "label").agg(
                F.count("*").alias("n"), F.count_if(~F.col("led")).alias("fresh")
            )
            mixed = (
                classes.groupBy("bucket")
                .agg(
                    F.sum("n").alias("n"),
                    F.count("*").alias("labels"),
                    F.sum("fresh").alias("fresh"),
                    F.max(F.struct("n", "label", "fresh")).alias("top"),
                )
                # Members of smaller classes that have not led yet.
                .withColumn("left", F.col("fresh") - F.col("top.fresh"))
                .filter("labels > 1 and left > 0")
                .select("bucket", "n", "left", F.col("top.label").alias("top"))
            )
            mixed = written(mixed, "mixed-buckets")
            wanted = mixed.agg(F.sum(F.col("n") * F.col("left"))).first()[0]
            if not wanted:
                return self.labels
            share = F.greatest(F.lit(budget / wanted), LEADERS / F.col("left"))
            place = F.pmod(F.xxhash64(F.lit(turn), "vid"), F.lit(1 << 30)) / float(1 << 30)
            leads = ~F.col("led") & (F.col("label") != F.col("top")) & (place < share)
            active = labelled.join(mixed, "bucket").withColumn("leads", leads)
            active = written(active.select(*labelled.columns, "leads"), "leading-members")
            sides = active.join(profiles.drop("size"), "vid")
            pairs = (
                sides.alias("y")
                .join(
                    sides.filter("leads").alias("x"),
                    (F.col("x.bucket") == F.col("y.bucket"))
                    & (F.col("x.label") != F.col("y.label"))
                    & self._may_link(),
                )
                .select(
                    F.col("x.vid").alias("u"),
                    F.col("x.label").alias("lu"),
                    F.col("y.vid").alias("v"),
                    F.col("y.label").alias("lv"),
                )
                .distinct()
            )
            links = self._measured(pairs).filter(F.col("similarity") >= self.similarity)
            found = links.select(F.col("lu").alias("u"), F.col("lv").alias("v")).distinct()
            self._merge(written(found, "links"))
            led = F.col("led") | F.col("leads")
            members = active.select(*members.drop("led").columns, led.alias("led"))


def _vertices(usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (``k1, k2, owner, vid, bands``), and links between the texts of one id.

    A text's owner is its least id, and its vid the owner. Of several texts with one owner only
    the least keeps it; the others take a number made from their hash, beyond all ids.
    """
    texts = written(
        usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("owner"), F.first("bands").alias("bands")),
        "distinct-texts",
    )
    key = F.struct("k1", "k2")
    shared = written(
        usable.groupBy("doc_id").agg(F.min(key).alias("least"), F.max(key).alias("most"))
        .filter("least <> most")
        .select("doc_id", "least"),
        "ids-of-several-texts",
    )
    again = F.col("least").isNotNull() & (F.col("least") != key)
    made = F.lit((1 << 63) - 1) - F.pmod(F.xxhash64("k1", "k2"), F.lit(1 << 61))
    owned = texts.join(shared.withColumnRenamed("doc_id", "owner"), "owner", "left")
    vertices = written(
        owned.select("k1", "k2", "owner", F.when(again, made).otherwise(F.col("owner")).alias("vid"), "bands"),
        "vertices",
    )
    of_id = usable.join(shared, "doc_id").select("doc_id", "k1", "k2").distinct()
    of_id = written(of_id.join(vertices, ["k1", "k2"]).select("doc_id", "vid"), "texts-of-ids")
    first = of_id.groupBy("doc_id").agg(F.min("vid").alias("u"))
    links = of_id.join(first, "doc_id").select("u", F.col("vid").alias("v")).filter("u <> v")
    return vertices, links


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    counted: bool = False,
) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row."""

    @F.arrow_udf("array<long>")
    def signed(texts: pa.Array) -> pa.Array:
        return band_codes(texts, bands, rows, counted)

    @F.arrow_udf("array<long>")
    def shingled(texts: pa.Array) -> pa.Array:
        return shingle_sets(texts, counted)

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    k1 = F.xxhash64("text")
    k2 = F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(7), "text", F.length("text")))
    scanned = written(
        named.select(
            "doc_id",
            k1.alias("k1"),
            k2.alias("k2"),
            signed("text").alias("bands"),
        ),
        "signatures",
    )
    usable = scanned.filter("doc_id is not null and k2 is not null")
    texts, given = _vertices(usable)
    rows_of = texts.select("vid", F.explode("bands").alias("bucket")).distinct()
    crowded = written(
        rows_of.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets"
    )
    crowd = written(rows_of.join(crowded, "bucket").select("vid", "bucket", "n"), "bucket-rows")
    # How central an id is: members of its buckets, all told.
    wanted = written(crowd.groupBy("vid").agg(F.sum("n").alias("degree")), "candidates")
    members = written(crowd.drop("n").join(wanted, "vid"), "bucket-members")
    near = texts.join(wanted, "vid", "left_semi").select(F.col("owner").alias("doc_id"), "k1", "k2", "vid")
    named = named.withColumns({"k1": k1, "k2": k2})
    features = written(
        named.join(near, ["doc_id", "k1", "k2"]).select("vid", shingled("text").alias("shingles")),
        "shingle-sets",
    )
    if features.count() > wanted.count():  # rows repeated with their id
        features = written(features.dropDuplicates(["vid"]), "shingle-sets")
    labels = _Links(members, features, similarity, given).run()

    # Copies join their text's least id, and rows of one id are one document.
    copies = texts.select("k1", "k2", "vid").join(labels, F.col("vid") == F.col("vertex"), "left")
    classes = written(
        copies.select("k1", "k2", "vid", F.coalesce("label", "vid").alias("class_id")), "text-classes"
    )
    found = scanned.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"], "left")
    return found.select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each class, that of its least id, with the columns it came with."""
    found = near_duplicates(docs, doc_id, text, **how)
    ids = written(
        found.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("class_id").alias("class_id"), F.count("*").alias("n")),
        "document-classes",
    )
    again = written(ids.filter("doc_id = class_id and n > 1").select("doc_id"), "repeated-ids")
    gone = written(ids.filter("doc_id <> class_id or n > 1").select("doc_id"), "dropped-ids")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.struct("*").alias("row"))
    single = rows.join(gone, "doc_id", "left_anti").select("row")
    # Rows that share an id: the one with the least hash stays, reduced before the shuffle.
    one = (
        rows.join(again, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        .select("row")
    )
    return single.unionByName(one).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
