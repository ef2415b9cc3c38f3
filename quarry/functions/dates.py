"""Date functions. Every one takes its "today" (as_of) as a column; none reads the clock."""

from __future__ import annotations

import datetime as dt
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ISO = r"\b(20\d{2}-\d{2}-\d{2})\b"


def iso_date(text: Column) -> Column:
    """The first ISO date in a text; null if there is none or no such day."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, _ISO, 1), F.lit("")), "yyyy-MM-dd")


def age_days(posted: Column, as_of: Column) -> Column:
    return F.date_diff(as_of, posted)


def posting_date_guess(text: Column, as_of: Column) -> Column:
    """Text of a posting date from phrases such as "posted 2 days ago", or an ISO date, or ""; as_of: a timestamp."""
    text = F.coalesce(text, F.lit(""))
    relative = r"(?i)posted\s+(\d+)\s*\+?\s*(hour|day|week|month)s?\s+ago"
    amount, unit = F.regexp_extract(text, relative, 1), F.lower(F.regexp_extract(text, relative, 2))
    hours = F.when(unit == "hour", 1).when(unit == "day", 24).when(unit == "week", 168).otherwise(720) * amount.try_cast("int")
    day = F.date_format(as_of - F.make_dt_interval(hours=hours), "yyyy-MM-dd")
    return (
        F.when(text.rlike(r"(?i)\bposted\s+today\b|\bjust\s+posted\b"), F.date_format(as_of, "yyyy-MM-dd"))
        .when(amount != "", F.concat(day, F.lit(" (approx, from 'posted "), F.coalesce(amount.try_cast("int").cast("string"), amount), F.lit(" "), unit, F.lit("(s) ago')")))
        .otherwise(F.regexp_extract(text, _ISO, 1))
    )


def within_hours(published: Column, as_of: Column, hours: int = 48) -> Column:
    """Not older than so many hours; an unknown time counts as recent."""
    return published.isNull() | (published >= as_of - F.make_dt_interval(hours=F.lit(hours)))


def utc_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def lease_until(now: Column, seconds: int) -> Column:
    return now + F.make_dt_interval(secs=F.lit(seconds))


def duration_seconds(start: Column, finish: Column) -> Column:
    return F.greatest(F.lit(0.0), (F.unix_micros(finish) - F.unix_micros(start)) / 1e6)


def drifted(a: Column, b: Column, seconds: int = 300) -> Column:
    return F.abs(F.unix_timestamp(a) - F.unix_timestamp(b)) > seconds


# ---- fixed values: contexts and shapes of walk-in dates ----
_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_NEAR = re.compile(
    r"\bwalk[-\s]?in\b|\bwalk[-\s]?in interview\b|\bwalk[-\s]?in drive\b|\bhiring drive\b|\binterview date\b|\bdrive date\b|\bhiring date\b|\binterview\b|\bdrive\b", re.I
)
_PAST = re.compile(
    r"\bhistorical_event\b|\bprevious\b|\blast\b|\bheld on\b|\bconducted on\b|\bpast\b|\bearlier\b|\bwas held\b|\bhad been held\b|\bestablished\b|\bfounded\b"
    r"|\bincorporated\b|\bexperience\b|\bgraduation\b|\bjoining date\b|\bdeadline\b",
    re.I,
)
_PAST_EVENT = re.compile(r"\b(?:previous|earlier|last|past)\s+(?:walk[-\s]?in|drive|interview|event)\b", re.I)
_REACH = 150
# ---- end of fixed values ----
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_RANGE = re.compile(rf"\b{_DAY}\s*(?:-|to|and)\s*{_DAY}\s+({_MONTHS})[a-z]*\s+(20\d{{2}})\b", re.I)
_SINGLE = re.compile(
    rf"\b(?:(?P<y1>20\d{{2}})[-/](?P<m1>\d{{1,2}})[-/](?P<d1>\d{{1,2}})|(?P<a2>\d{{1,2}})[-/](?P<b2>\d{{1,2}})[-/](?P<y2>20\d{{2}})"
    rf"|(?P<d3>\d{{1,2}})(?:st|nd|rd|th)?\s+(?P<m3>{_MONTHS})[a-z]*\s+(?P<y3>20\d{{2}})|(?P<m4>{_MONTHS})[a-z]*\s+(?P<d4>\d{{1,2}})(?:st|nd|rd|th)?\s+(?P<y4>20\d{{2}}))\b",
    re.I,
)
_MONTH_NUMBER = {m: i + 1 for i, m in enumerate(_MONTHS.split("|"))}


def _day(year: str, month: int, day: str) -> dt.date | None:
    try:
        return dt.date(int(year), month, int(day))
    except ValueError:
        return None


def _single(m: re.Match) -> dt.date | None:
    if m["y1"]:
        return _day(m["y1"], int(m["m1"]), m["d1"])
    if m["y2"]:  # month first, unless only day first is a date
        return _day(m["y2"], int(m["a2"]), m["b2"]) or _day(m["y2"], int(m["b2"]), m["a2"])
    if m["y3"]:
        return _day(m["y3"], _MONTH_NUMBER[m["m3"].lower()[:3]], m["d3"])
    return _day(m["y4"], _MONTH_NUMBER[m["m4"].lower()[:3]], m["d4"])


def _gap(spans: list[tuple[int, int]], start: int, end: int) -> float:
    return min((max(0, start - b, a - end) for a, b in spans), default=float("inf"))


def find_walkin_dates(text: str | None, today: dt.date) -> tuple[dt.date, dt.date] | None:
    """First and last day of the walk-in that a text announces.

    A date counts if a walk-in context is within reach and nearer than any context of the past. Of
    those that end today or later the earliest start wins, else the latest end.
    """
    found: list[tuple[dt.date, dt.date]] = []
    for block in re.split(r"[\n|]+", (text or "").replace("–", "-").replace("—", "-")):
        block = _PAST_EVENT.sub("historical_event", block.strip())
        near, past = ([m.span() for m in p.finditer(block)] for p in (_NEAR, _PAST))

        def counts(m: re.Match, near=near, past=past) -> bool:
            close = _gap(near, *m.span())
            return close <= _REACH and _gap(past, *m.span()) > close

        for m in _RANGE.finditer(block):
            days = [_day(m[4], _MONTH_NUMBER[m[3].lower()[:3]], m[i]) for i in (1, 2)]
            if all(days) and counts(m):
                found.append((min(days), max(days)))
        for m in _SINGLE.finditer(block):
            day = _single(m)
            if day and not any(a <= day <= b for a, b in found) and counts(m):
                found.append((day, day))
    ahead = [x for x in found if x[1] >= today]
    return min(ahead, key=lambda x: x[0]) if ahead else max(found, key=lambda x: x[1], default=None)


@F.arrow_udf(T.StructType([T.StructField("start", T.DateType()), T.StructField("end", T.DateType())]))
def _walkin(text: pa.Array, as_of: pa.Array) -> pa.Array:
    out = [find_walkin_dates(t, d) if d else None for t, d in zip(text.to_pylist(), as_of.to_pylist(), strict=True)]
    return pa.array([x and {"start": x[0], "end": x[1]} for x in out], pa.struct([("start", pa.date32()), ("end", pa.date32())]))


def walkin_dates(text: Column, as_of: Column) -> Column:
    """STRUCT<start DATE, end DATE>, or null. Nearest-context search has no column form: an Arrow UDF."""
    return _walkin(text, as_of)


def walkin_status(start: Column, end: Column, claimed: Column, as_of: Column) -> Column:
    """STRUCT<date, status, conflict>: the source's own dates beat a claimed one that they exclude."""
    claim = F.try_to_date(F.nullif(F.regexp_extract(F.coalesce(claimed, F.lit("")), r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")
    has_claim = F.coalesce(claimed, F.lit("")).rlike(r"\d{4}-\d{2}-\d{2}")
    fits = (start.isNull() & end.isNull()) | claim.between(start, end) | (claim == start)
    day = F.when(has_claim & claim.isNull(), None).when(has_claim & fits, claim).otherwise(start)
    conflict = (has_claim & claim.isNotNull() & ~F.coalesce(fits, F.lit(False))) | (~has_claim & start.isNotNull() & (F.coalesce(claimed, F.lit("")) != "") & (F.date_format(start, "yyyy-MM-dd") != claimed))
    first, last = F.coalesce(start, day), F.coalesce(end, day)
    status = F.when(day.isNull(), "unknown").when(as_of > last, "expired").when((as_of >= first) & (as_of <= last), "active").otherwise("upcoming")
    return F.struct(day.alias("date"), status.alias("status"), F.coalesce(conflict, F.lit(False)).alias("conflict"))
