"""Personal data: linear patterns against the plain ones, checks, positions and redaction."""

import re

import pytest
from pyspark.sql import functions as F

from effortlens.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(t - 9 * (t > 9) for t in twice) % 10 == 0
    return True


def plain_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f x@y a@b@c.d me@host.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111 4",
    "+1 (234) 567-8901 +49.30.1234567. +12 +1",
    "é😀é me@x.org 😀 +1 234 567 8901",
    "a." * 20000,
    "9" * 20000,
    "1 " * 5000 + "4111111111111111",
    "a@b.co " * 700,
    "x" * 20000 + "@y.z",
]


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "n int, text string")
    twice = rows.unionByName(rows).withColumn("spans", F.lit("mine"))
    return pii.find_spans(twice).collect()


def test_spans_are_those_of_the_plain_patterns(found):
    assert len(found) == 2 * len(TEXTS)
    for row in found:
        got = [(s.kind, s.start, s.stop) for s in row.spans if s.kind in pii.BASE]
        assert got == plain_spans(TEXTS[row.n]), row.n
        assert all(TEXTS[row.n][s.start : s.stop] == s.value for s in row.spans)


def test_iban_needs_its_check_digits_and_context_raises_the_score(spark):
    text = "GB82 WEST 1234 5698 7654 32, iban DE89370400440532013000. DE88370400440532013000"
    (row,) = pii.find_spans(spark.createDataFrame([(text,)], "text string")).collect()
    ibans = [s for s in row.spans if s.kind == "iban"]
    assert [s.value for s in ibans] == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    assert ibans[0].score < ibans[1].score


def test_running_sums_over_several_blocks(spark):
    n = 3 * 256 + 7
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>").alias("a"))
    (row,) = df.select(pii.running_sums(F.col("a")).alias("s")).collect()
    assert row.s == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_redaction_and_empty_tables(spark):
    rows = spark.createDataFrame([("é me@x.org +1 234 567 8901.",), (None,)], "text string")
    assert [r.text for r in pii.redact(rows).collect()] == ["é <EMAIL> <PHONE>.", None]
    assert pii.find_spans(rows.limit(0)).count() == 0


def test_context_on_either_side_decides_weak_kinds(spark):
    texts = [
        "routing number 021000021 here",
        "021000021 is my bank",
        "lot 021000021 of screws",
        "routing number 021000022",
        "device 490154203237518",
        "total 490154203237518",
        "SSN: 078-05-1120, ssn 666-05-1120, ssn 078-00-1120",
        "part 078-05-1120",
        "shipaba 021000021",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = {
        r.n: [(s.kind, s.value, round(s.score, 6)) for s in r.spans if s.kind in pii.WEAK]
        for r in pii.find_spans(rows).collect()
    }
    routing, imei = ("routing", "021000021", 0.6), ("imei", "490154203237518", 0.6)
    assert found == {0: [routing], 1: [routing], 2: [], 3: [], 4: [imei], 5: [], 6: [("ssn", "078-05-1120", 0.6)], 7: [], 8: []}
