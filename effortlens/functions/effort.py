"""Effort durations written in free-form custom fields, as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field-name keywords, number pattern, hour marks and label units that
# results depend on.
ESTIMATE_KEYWORDS = ["estimated time", "estimated_time", "estimate", "見積", "見積もり"]
ACTUAL_KEYWORDS = [
    "actual time",
    "actual_time",
    "spent time",
    "tracked time",
    "実績",
    "実働",
    "工数",
    "稼働",
]
FIRST_NUMBER = r"[-+]?[0-9]*\.?[0-9]+"
HOUR_MARK = r"[hH]|時間"
HOUR_UNIT, MINUTE_UNIT = "時間", "分"


def _mentions(name: Column, keywords: list[str]) -> Column:
    return reduce(or_, [name.contains(word) for word in keywords])


def duration_minutes(number: Column, text: Column, display: Column) -> Column:
    """Minutes held by one custom field, or null.

    A numeric value wins and already counts minutes. Otherwise the first number
    of the first non-empty text is read, as hours when an hour mark appears
    anywhere in that text and as minutes when none does.
    """
    words = F.coalesce(F.nullif(text, F.lit("")), display)
    amount = F.regexp_extract(words, FIRST_NUMBER, 0).try_cast("double")
    scale = F.when(words.rlike(HOUR_MARK), 60.0).otherwise(1.0)
    return F.coalesce(number.cast("double"), amount * scale)


def readable_fields(custom_fields: Column) -> Column:
    """Array of (is an estimate, is an actual, minutes), one element per field.

    A field named both ways is an estimate only. Keep the result in a column of its own
    before picking from it twice, so that the fields are parsed once.
    """

    def read(field: Column) -> Column:
        name = F.lower(F.coalesce(field["name"], F.lit("")))
        minutes = duration_minutes(
            field["number_value"], field["text_value"], field["display_value"]
        )
        is_estimate = _mentions(name, ESTIMATE_KEYWORDS)
        return F.struct(
            is_estimate.alias("is_estimate"),
            (~is_estimate & _mentions(name, ACTUAL_KEYWORDS)).alias("is_actual"),
            minutes.alias("minutes"),
        )

    return F.transform(custom_fields, read)


def _last_minutes(readable: Column, kind: str) -> Column:
    held = F.filter(readable, lambda f: f[kind] & f["minutes"].isNotNull())
    return F.try_element_at(held, F.lit(-1))["minutes"]


def estimate_from(readable: Column) -> Column:
    """Minutes of the last field that is an estimate and holds a duration."""
    return _last_minutes(readable, "is_estimate")


def actual_from(readable: Column) -> Column:
    """Minutes of the last field that is an actual and holds a duration."""
    return _last_minutes(readable, "is_actual")


def remaining_minutes(estimated: Column, actual: Column) -> Column:
    """Estimate left over after the actual effort, never below zero."""
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(estimated, zero) - F.coalesce(actual, zero), zero)


def has_effort(estimated: Column, actual: Column) -> Column:
    """True when either duration is present and not zero."""
    zero = F.lit(0.0)
    return (F.coalesce(estimated, zero) != 0) | (F.coalesce(actual, zero) != 0)


def label_from_minutes(minutes: Column) -> Column:
    """Whole hours and minutes as text; half minutes round to even, null reads as zero."""
    whole = F.coalesce(F.rint(minutes), F.lit(0.0)).cast("bigint")
    return F.concat(
        F.floor(whole / 60).cast("string"),
        F.lit(HOUR_UNIT),
        F.pmod(whole, F.lit(60).cast("bigint")).cast("string"),
        F.lit(MINUTE_UNIT),
    )


def label_from_hours(hours: Column) -> Column:
    return label_from_minutes(hours * 60)
