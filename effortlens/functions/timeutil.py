"""Calendar expressions over UTC instants.

Instants are ``TIMESTAMP_NTZ`` columns holding UTC, so no result depends on
``spark.sql.session.timeZone``. Calendar days and months are those of a named
business zone, ``Asia/Tokyo`` unless a caller says otherwise.
"""

from __future__ import annotations

import re
from datetime import date, datetime, time, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "Asia/Tokyo"

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")
_OFFSET_AT_END = r"[T ].*[+-]\d{2}(:?\d{2})?$"
_STEADY_FROM, _STEADY_UNTIL = (1970, 1, 1), (2100, 1, 1)
_CALENDAR_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def ntz_literal(instant: datetime) -> Column:
    """A UTC instant as a constant of type ``TIMESTAMP_NTZ``."""
    if instant.tzinfo is not None:
        instant = instant.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(instant.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to a UTC ``TIMESTAMP_NTZ``; null when it is not a timestamp.

    A plain cast to ``TIMESTAMP_NTZ`` drops a numeric offset, so text that ends
    with one goes through the instant type and is counted from the epoch. The
    pattern that finds offsets is tried only on text not closed by ``Z``.
    """
    wall_clock = text.try_cast("timestamp_ntz")
    since_epoch = F.timestamp_add(
        "MICROSECOND",
        F.unix_micros(text.try_cast("timestamp")),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    )
    has_offset = ~text.endswith("Z") & text.rlike(_OFFSET_AT_END)
    return F.when(has_offset, since_epoch).otherwise(wall_clock)


def parse_day(text: Column) -> Column:
    """``YYYY-MM-DD`` text to a date; null for any other text."""
    return F.when(text.rlike(_CALENDAR_DAY), text.try_cast("date"))


def iso_millis(instant: Column) -> Column:
    """UTC instant as ``YYYY-MM-DDTHH:MM:SS.mmmZ``, truncated to milliseconds."""
    plain = instant.cast("string")
    millis = F.rpad(F.substring(plain, 21, 3), 3, "0")
    return F.concat(
        F.substring(plain, 1, 10),
        F.lit("T"),
        F.substring(plain, 12, 8),
        F.lit("."),
        millis,
        F.lit("Z"),
    )


def parse_mark(text: str) -> datetime:
    """The instant that ``iso_millis`` wrote."""
    return datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%fZ")


@lru_cache
def _steady_offset(zone: str) -> int | None:
    """Seconds east of UTC, if the zone keeps one offset from 1970 through 2099."""
    start = datetime(*_STEADY_FROM, tzinfo=timezone.utc)
    days = (datetime(*_STEADY_UNTIL, tzinfo=timezone.utc) - start).days
    info = ZoneInfo(zone)
    offsets = {(start + timedelta(days=d)).astimezone(info).utcoffset() for d in range(days)}
    return int(offsets.pop().total_seconds()) if len(offsets) == 1 else None


def to_local(instant: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Wall clock of a UTC instant in the zone.

    Where the zone's offset never changes, the instant is shifted by it, which costs a
    fraction of a general conversion; instants outside that period convert in full.
    """
    converted = F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)
    offset = _steady_offset(zone)
    if offset is None:
        return converted
    steady = (instant >= ntz_literal(datetime(*_STEADY_FROM))) & (
        instant < ntz_literal(datetime(*_STEADY_UNTIL))
    )
    shifted = F.timestamp_add("SECOND", F.lit(offset), instant)
    return F.when(steady, shifted).otherwise(converted)


def to_utc(wall_clock: Column, zone: str = BUSINESS_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock)


def local_day(instant: Column, zone: str = BUSINESS_ZONE) -> Column:
    return F.to_date(to_local(instant, zone))


def local_month_start(instant: Column, zone: str = BUSINESS_ZONE) -> Column:
    """First day of the instant's month in the zone: a cheaper key than the month's text."""
    return F.trunc(local_day(instant, zone), "month")


def month_text(day: Column) -> Column:
    """``YYYY-MM`` of a date."""
    return F.substring(day.cast("string"), 1, 7)


def local_month(instant: Column, zone: str = BUSINESS_ZONE) -> Column:
    """``YYYY-MM`` of the instant in the zone."""
    return month_text(local_day(instant, zone))


def local_day_start(day_text: Column, zone: str = BUSINESS_ZONE) -> Column:
    """UTC instant at which the given ``YYYY-MM-DD`` starts in the zone; else null."""
    return to_utc(parse_day(day_text).cast("timestamp_ntz"), zone)


def day_start_utc(day: date, zone: str = BUSINESS_ZONE) -> datetime:
    start = datetime.combine(day, time(), tzinfo=ZoneInfo(zone))
    return start.astimezone(timezone.utc).replace(tzinfo=None)


def month_bounds(month: str) -> tuple[date, date]:
    """First day of ``YYYY-MM`` and first day of the month after it."""
    if not _MONTH.fullmatch(month):
        raise ValueError(f"month must be YYYY-MM, got {month!r}")
    year, number = int(month[:4]), int(month[5:])
    following = date(year + number // 12, number % 12 + 1, 1)
    return date(year, number, 1), following


def within_local_days(
    instant: Column, first: date, last: date, zone: str = BUSINESS_ZONE
) -> Column:
    """True when the instant falls on a local day in ``[first, last]``.

    Stated as a half-open range on the bare column, which a parquet scan can
    take as a pushed filter.
    """
    low = ntz_literal(day_start_utc(first, zone))
    high = ntz_literal(day_start_utc(last + timedelta(days=1), zone))
    return (instant >= low) & (instant < high)


def within_local_month(instant: Column, month: str, zone: str = BUSINESS_ZONE) -> Column:
    first, following = month_bounds(month)
    return within_local_days(instant, first, following - timedelta(days=1), zone)


def months_between(first: date, last: date) -> list[str]:
    """Every ``YYYY-MM`` touched by the closed day range."""
    count = (last.year - first.year) * 12 + last.month - first.month
    start = first.year * 12 + first.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(start, start + count + 1)]


def local_today(now: datetime, zone: str = BUSINESS_ZONE) -> date:
    """Calendar day in the zone of an aware (or naive UTC) moment."""
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    return now.astimezone(ZoneInfo(zone)).date()
