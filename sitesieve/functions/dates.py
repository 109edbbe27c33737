"""Dates as Column expressions; the reference date is always a parameter."""

from __future__ import annotations

import calendar
import datetime
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sitesieve.functions import fixed

SPANS = "array<struct<start:int,stop:int,day:date>>"
_PATTERNS = [(kind, re.compile(p, re.I)) for kind, p in fixed.DATES]


def iso(text: Column) -> Column:
    """YYYY-MM-DD, or YYYY-MM as the month's last day; null if there is none that is valid."""
    y, m, d = (F.regexp_extract(text, r"\b(\d{4})-(\d{2})(?:-(\d{2}))?\b", i) for i in (1, 2, 3))
    day = F.try_to_date(F.concat_ws("-", y, m, F.when(d == "", "01").otherwise(d)), "yyyy-MM-dd")
    return F.when(d == "", F.last_day(day)).otherwise(day)


def whole_months(older: Column, newer: Column) -> Column:
    return (F.year(newer) - F.year(older)) * 12 + F.month(newer) - F.month(older) - F.when(F.dayofmonth(newer) < F.dayofmonth(older), 1).otherwise(0)


def is_stale(day: Column, as_of: Column, days: int = fixed.STALE_DAYS) -> Column:
    return F.datediff(as_of, day) > days


def year_is_stale(year: Column, as_of: Column) -> Column:
    """Whether even the last day of the year is."""
    return is_stale(F.make_date(year, F.lit(12), F.lit(31)), as_of)


def month_of(word: str) -> int:
    """The number of a month named in Russian or English, 0 if it is none."""
    word = word.lower()
    for stem, n in [*fixed.RU_MONTHS, *((x, i) for i, x in enumerate(fixed.EN_MONTHS, 1))]:
        if word.startswith(stem):
            return n
    return 0


def _day(kind: str, found: tuple, last_year: int) -> datetime.date | None:
    """The date of a match; a month without a day is its last day, so that it is never older than it may be."""
    part = dict(zip(kind, found, strict=False))
    y = int(part["y"])
    if kind == "Sy":
        m = next((n for stem, n in fixed.SEASONS if part["S"].lower().startswith(stem)), 0)
    else:
        m = month_of(part["M"]) if "M" in part else int(part["m"])
    d = int(part["d"]) if part.get("d") else None
    if kind == "dmy" and m > 12 >= d:  # the month first
        d, m = m, d
    if not (1990 <= y <= last_year and 1 <= m <= 12):
        return None
    longest = calendar.monthrange(y, m)[1]
    return datetime.date(y, m, d or longest) if d is None or 1 <= d <= longest else None


def spans_of(text: str, as_of: datetime.date) -> list[tuple[int, int, datetime.date]]:
    """Start, end and date of all dates in a text, in order; what an earlier pattern claims no later one reads."""
    claimed, out = bytearray(len(text)), []
    for kind, pattern in _PATTERNS:
        for m in pattern.finditer(text):
            if any(claimed[m.start() : m.end()]):
                continue
            day = _day(kind, m.groups(), as_of.year + 2)
            if day:
                claimed[m.start() : m.end()] = b"\1" * (m.end() - m.start())
                out.append((m.start(), m.end(), day))
    return sorted(out)


def spans(text: Column, as_of: datetime.date) -> Column:
    """SPANS of the dates in a text, of the precision of a month at least, from 1990 to two years after as_of."""

    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("day", pa.date32())]))
        dated = re.compile(fixed.YEAR)  # most lines have no year and are passed over
        return pa.array([[{"start": a, "stop": b, "day": d} for a, b, d in spans_of(x, as_of)] if x and dated.search(x) else [] for x in texts.to_pylist()], kind)

    return found(text)


def days(spans: Column) -> Column:
    return F.transform(spans, lambda s: s["day"])


def entry_day(line: Column, spans: Column) -> Column:
    """The date of an entry: of a line (trimmed) that starts with one, or that has at most 40 characters beside it."""
    first = F.try_element_at(spans, F.lit(1))
    rest = F.concat(F.substring(line, F.lit(1), first["start"]), F.lit(" "), F.substr(line, first["stop"] + 1))
    return F.when((first["start"] <= 1) | (F.length(F.trim(F.regexp_replace(rest, r"(?U)\s+", " "))) <= 40), first["day"])


def without(line: Column, spans: Column) -> Column:
    """The line with its dates blanked."""
    cut = lambda acc, s: F.struct((acc["at"] + (s["stop"] - acc["at"])).alias("at"), F.concat(acc["out"], F.substr(line, acc["at"] + 1, s["start"] - acc["at"]), F.lit(" ")).alias("out"))
    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut)
    return F.concat(done["out"], F.substr(line, done["at"] + 1))
