"""Personal data in whole texts, in DataFrame functions only.

Patterns propose spans; checks confirm them (address parts, digit counts, Luhn, mod 97, weighted
sums); words within ``CONTEXT`` code points on either side of a span, up to the next span of its
kind and after it to the end of the clause, raise its score. A pattern's matches come from ``regexp_extract_all``
and the text between them from ``split``, so the position of a match is the running sum of
piece lengths, in code points; sums run over blocks, which keeps texts with very many matches
cheap. A text that lacks a kind's key character is not searched for the kind at all.

The patterns below are equivalent to the plain ones of each kind but match in linear time and
without recursion: runs are possessive, and a match may start inside a run of its first
characters only where the match before ended.

Kinds: email, ip, card and phone; on top of these iban, imei, routing (bank numbers of nine
digits) and ssn. A base kind's span is reported whatever its score. The others need their check
and a score of at least ``MIN_SCORE``: an iban's check digits reach it alone, while the same
nine or fifteen digits are a span near words that say what they are and none elsewhere.

Defined results: a null text counts as empty and has no spans; repeated rows are searched
alike; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pattern, a condition that every text with a match meets, context words.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = {
    "email": (
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
        "@",
        "e-?mail|mail|contact|write|correo|courriel|kontakt",
    ),
    "ip": (
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        "ip|address|host|server|login|adresse|direcci",
    ),
    "card": (
        r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
        None,
        "card|visa|master|credit|debit|payment|karte|carte|tarjeta",
    ),
    "phone": (
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        "phone|tel|call|mobile|fax|anruf|appel|tel[eé]fono",
    ),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        None,
        "iban|account|bank|konto|compte|cuenta",
    ),
    "imei": (
        r"(?<![0-9])[0-9]{15}(?![0-9])",
        None,
        "imei|device|handset|phone|mobile",
    ),
    "routing": (
        r"(?<![0-9])[0-9]{9}(?![0-9])",
        None,
        "routing|aba|bank|wire|transfer|account",
    ),
    "ssn": (
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "-",
        "ssn|social|security|tax",
    ),
}
BASE = ("email", "ip", "card", "phone")
CONTEXT = 40
START_SCORE = 0.6
WEAK_SCORE = 0.3  # of kinds whose check passes by chance: one in ten, or nearly always
WEAK = ("imei", "routing", "ssn")
CONTEXT_SCORE = 0.3
MIN_SCORE = 0.5
_BLOCK = 256

_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_DIGITS = "0123456789"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def running_sums(sizes: Column) -> Column:
    """Sum of each element and all before it, over blocks so that long arrays stay cheap."""
    zero = F.lit(0).cast("long")

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: a + x)

    n = F.size(sizes)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
        lambda b: total(F.slice(sizes, b * _BLOCK + 1, _BLOCK)),
    )

    def upto(i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        return total(F.slice(blocks, 1, block)) + total(
            F.slice(sizes, block * _BLOCK + 1, i - block * _BLOCK + 1)
        )

    empty = F.array().cast("array<bigint>")
    every = F.transform(F.sequence(F.lit(0), n - 1), upto)
    return F.when(n > 0, every).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, at: Column) -> Column:
        d = F.substring(digits, -at, F.lit(1)).cast("int")
        twice = F.when(d < 5, 2 * d).otherwise(2 * d - 9)
        return total + F.when(at % 2 == 0, twice).otherwise(d)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether check digits are right: letters count 10 to 35, the first four come last."""
    moved = F.concat(
        F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4)
    )
    marks = F.split(moved, "")

    def fold(rest: Column, mark: Column) -> Column:
        number = F.instr(F.lit(_DIGITS + _LETTERS), mark) - 1
        return F.when(mark == "", rest).otherwise(
            (rest * F.when(number > 9, 100).otherwise(10) + number) % 97
        )

    return F.aggregate(marks, F.lit(0), fold) == 1


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        bare = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(False)
    if kind == "imei":
        return luhn(value)
    if kind == "routing":
        digit = [F.substring(value, i, 1).cast("int") for i in range(1, 10)]
        total = sum((d * w for d, w in zip(digit, (3, 7, 1) * 3, strict=True)), F.lit(0))
        return (total > 0) & (total % 10 == 0)
    if kind == "ssn":  # no such area, group or serial number is given out
        return ~value.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


_SPAN = "struct<kind: string, start: bigint, stop: bigint, value: string, score: double>"


def find_spans(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with ``spans``: kind, start, stop (code points), value and score of each span.

    A column of that name in ``df`` is replaced.
    """
    given = [c for c in df.columns if c != spans]
    rows = df.select(F.struct(*given).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = []
    for kind, (pattern, needs, _) in KINDS.items():
        there = F.col("text").rlike("[0-9]") if needs is None else F.instr("text", needs) > 0
        pieces += [
            F.when(there, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
            .otherwise(F.array().cast("array<string>"))
            .alias(f"{kind}_found")
        ]
    rows = rows.select("row", "text", *pieces)
    rows = rows.select(
        "row",
        *[f"{k}_found" for k in KINDS],
        *[
            F.when(F.size(f"{k}_found") > 0, F.split("text", p))
            .otherwise(F.array().cast("array<string>"))
            .alias(f"{k}_gaps")
            for k, (p, _, _) in KINDS.items()
        ],
    )

    def stops_of(kind: str) -> Column:
        def size(value: Column, i: Column) -> Column:
            return (F.length(value) + F.length(F.get(f"{kind}_gaps", i))).cast("long")

        return running_sums(F.transform(F.col(f"{kind}_found"), size))

    sums = [stops_of(k).alias(f"{k}_stops") for k in KINDS]
    rows = rows.select("row", *[f"{k}_{p}" for k in KINDS for p in ("found", "gaps")], *sums)

    def spans_of(kind: str) -> Column:
        words = KINDS[kind][2]

        def span(value: Column, i: Column) -> Column:
            stop = F.get(f"{kind}_stops", i)
            before = F.right(F.get(f"{kind}_gaps", i), F.lit(CONTEXT))
            after = F.left(F.get(f"{kind}_gaps", i + 1), F.lit(CONTEXT))
            after = F.regexp_extract(after, r"^[^,.;:!?\n]*", 0)
            near = F.lower(F.concat(before, F.lit("\n"), after)).rlike(rf"\b(?:{words})")
            start = WEAK_SCORE if kind in WEAK else START_SCORE
            score = start + F.when(near, CONTEXT_SCORE).otherwise(0.0)
            return F.when(
                _confirmed(kind, value) & (score >= (0.0 if kind in BASE else MIN_SCORE)),
                F.struct(
                    F.lit(kind).alias("kind"),
                    (stop - F.length(value)).alias("start"),
                    stop.alias("stop"),
                    value.alias("value"),
                    score.cast("double").alias("score"),
                ),
            )

        return F.filter(F.transform(F.col(f"{kind}_found"), span), lambda s: s.isNotNull())

    found = F.concat(*[spans_of(k).cast(f"array<{_SPAN}>") for k in KINDS])
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in given], found.alias(spans))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas, in their order."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def redact(df: DataFrame, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """``df`` with every span of at least ``min_score`` in ``text`` replaced by ``<KIND>``.

    Where spans overlap, the earlier one counts, and of two with one start the longer.
    """
    found = find_spans(df, text, "__spans")
    usable = F.filter("__spans", lambda s: s["score"] >= min_score)
    order = F.array_sort(
        F.transform(
            usable, lambda s: F.struct(s["start"].alias("a"), (-s["stop"]).alias("b"), s["kind"].alias("k"))
        )
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    done = F.aggregate(
        order,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.when(s["a"] < acc["upto"], acc).otherwise(
            F.struct(
                F.concat(
                    acc["out"],
                    F.substring(whole, (acc["upto"] + 1).cast("int"), (s["a"] - acc["upto"]).cast("int")),
                    F.lit("<"),
                    F.upper(s["k"]),
                    F.lit(">"),
                ).alias("out"),
                (-s["b"]).alias("upto"),
            )
        ),
        lambda acc: F.concat(
            acc["out"], F.substring(whole, (acc["upto"] + 1).cast("int"), F.length(whole))
        ),
    )
    return found.withColumn(text, F.when(F.col(text).isNotNull(), done)).drop("__spans")
