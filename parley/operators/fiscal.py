"""Fiscal calendar and timelines (April to March years). Column -> Column, no UDF.

Null and unparseable texts give null, unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import let

#: Least number of years a target is away, so that growth stays finite.
YEARS_FLOOR = 0.25
# Parts of a year in the order in which they are looked for, and the years they end before the fiscal year's end.
PART_OFFSETS = (("H1", 0.5), ("H2", 0.0), ("Q1", 0.75), ("Q2", 0.5), ("Q3", 0.25), ("Q4", 0.0))
# Calendar-quarter average rupees for one US dollar; the ends of the list hold for all earlier and later dates.
USDINR_FIRST_YEAR = 2013
USDINR = (
    54.3, 56.5, 61.5, 62.0, 61.8, 59.8, 60.6, 61.9, 62.2, 63.5, 64.9, 65.9, 67.5, 66.9, 66.9, 67.5, 66.9, 64.5, 64.3, 64.7, 64.3, 67.1, 70.1, 72.6, 70.5, 69.6,
    71.0, 71.2, 72.5, 75.9, 74.4, 73.8, 72.8, 73.8, 74.0, 74.8, 75.3, 77.3, 79.7, 81.5, 82.3, 82.0, 82.7, 83.3, 82.9, 83.4, 83.7, 84.5, 86.4, 85.6, 86.0, 86.5,
)
USDINR_DEFAULT = 83.4
# Words for the running and the following fiscal year.
THIS_YEAR = r"\b(this|current)\s+(financial|fiscal)\s+year\b|\bthis\s+fiscal\b|\bend\s+of\s+(this|the)\s+(financial|fiscal)\s+year\b"
NEXT_YEAR = r"\bnext\s+(financial|fiscal)\s+year\b|\bnext\s+year\b|\bcoming\s+year\b"
# How titles write a fiscal year, and the quarter a month ends.
TITLE_YEAR = r"\bf\.?\s*y\.?['‘’`´°\-.\s]*(?:\d{2,4}\s*[-/]\s*)?(\d{2,4})\b"
QUARTER_ENDS = {"june": 1, "september": 2, "december": 3, "march": 4}


def _int(c: Column) -> Column:
    return c.try_cast("int")


def century(y: Column) -> Column:
    """A two-digit year in the 2000s; larger numbers stay."""
    return let(y, lambda v: F.when(v > 100, v).otherwise(v + 2000))


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return let(F.regexp_extract(c, pattern, group), lambda x: F.when(x != "", x))


def period_year(period: Column) -> Column:
    """The first fiscal year named in a call period: 'Q4 FY24' -> 2024."""
    return century(_int(F.regexp_extract(period, r"(?i)FY\s*(\d{2,4})", 1)))


def trailing_year(text: Column) -> Column:
    """The year from the last two to four digits of a text that ends in them."""
    return century(_int(F.regexp_extract(F.trim(text), r"(\d{2,4})$", 1)))


def year_range(timeline: Column) -> Column:
    """struct(lo, hi) of fiscal years: 'FY28-29' -> (2028, 2029), 'H1 FY27' -> (2027, 2027); nulls if it tells none."""
    plain = F.trim(F.regexp_replace(F.coalesce(timeline, F.lit("")), r"(?i)\b(H[12]|Q[1-4])\s*", ""))
    pair = r"(?i)FY\s*(\d{2,4})\s*[-–]\s*(?:FY\s*)?(\d{2,4})"

    def years(p: Column) -> Column:
        a, b = (century(_int(F.regexp_extract(p, pair, g))) for g in (1, 2))
        return let(F.array_compact(F.array(a, b)), lambda two: F.when(F.size(two) > 0, two).otherwise(F.array(trailing_year(p))))

    found = let(plain, years)
    return F.struct(F.array_min(found).alias("lo"), F.array_max(found).alias("hi"))


def part_offset(timeline: Column) -> Column:
    """Years by which the part of a year named first in the order of PART_OFFSETS ends early; 0 for whole years and null."""

    def offset(t: Column) -> Column:
        out = F.lit(0.0)
        for part, years in reversed(PART_OFFSETS):
            out = F.when(t.contains(part), F.lit(years)).otherwise(out)
        return out

    return let(F.upper(F.coalesce(timeline, F.lit(""))), offset)


def years_until(year: Column, call_year: Column, timeline: Column) -> Column:
    """Years from the call's fiscal year to the end of the timeline, at least YEARS_FLOOR."""
    return F.when(year.isNotNull() & call_year.isNotNull(), F.greatest((year - call_year).cast("double") - part_offset(timeline), F.lit(YEARS_FLOOR)))


def horizon(timeline: Column, call_year: Column) -> Column:
    """near, medium or long by the last year of the timeline; timelines without a year are near."""
    return let(year_range(timeline)["hi"] - call_year, lambda away: F.when(away > 2, "long").when(away == 2, "medium").otherwise("near"))


def base_year(period: Column, default: int = 2024) -> Column:
    """The last complete fiscal year at a call: the call's own for Q4, else the one before; `default` if it can't be read."""
    q, y = (_int(F.regexp_extract(period, r"(?i)Q\s*([1-4])\s*FY\s*'?(\d{2,4})", g)) for g in (1, 2))
    full = let(y, lambda v: F.when(v < 100, v + 2000).otherwise(v))
    return F.coalesce(full - F.when(q == 4, 0).otherwise(1), F.lit(default))


def fiscal_year2(day: Column) -> Column:
    """Two digits of the running fiscal year; the year that ends in a century is 100, as the callers count on."""
    return F.when(F.month(day) >= 4, F.year(day) % 100 + 1).otherwise(F.year(day) % 100)


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, -3))


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def reported_quarter(day: Column) -> Column:
    """struct(quarter, fy): the quarter whose results are announced on a day."""
    m = F.month(day)
    q = F.when(m.between(4, 6), "Q4").when(m.between(7, 9), "Q1").when(m.between(10, 12), "Q2").when(m.isNotNull(), "Q3")
    return F.struct(q.alias("quarter"), F.when(m >= 7, F.year(day) + 1).otherwise(F.year(day)).alias("fy"))


def timeline_end(normalized: Column) -> Column:
    """Last day of 'FY27', 'H1 FY27' or 'Q3 FY27'; null for any other text."""
    y = _int(_found(normalized, r"^(?:[HQ][1-4] )?FY(\d{2})$")) + 2000
    part = F.regexp_extract(normalized, r"^([HQ][1-4]) FY\d{2}$", 1)
    day = lambda year, month, d: F.make_date(year, F.lit(month), F.lit(d))
    out = F.when(part == "Q1", day(y - 1, 6, 30)).when(part.isin("Q2", "H1"), day(y - 1, 9, 30)).when(part == "Q3", day(y - 1, 12, 31))
    return F.when(part.isin("H3", "H4"), F.lit(None).cast("date")).otherwise(out.otherwise(day(y, 3, 31)))


def year2(text: Column, day: Column) -> Column:
    """Two-digit fiscal year a free text names, in words relative to a day if it has no number; null if it names none.

    The 'FY' of a number must begin a word: 'H1FY28' names no year.
    """
    low = F.lower(text)
    return F.coalesce(
        _int(_found(low, r"\bfy\s*(\d{2,4})\b")) % 100,
        _int(_found(text, r"\b20\d{2}[/\-](\d{2,4})\b")) % 100,
        _int(_found(text, r"\b(20\d{2})\b")) % 100,
        F.when(low.rlike(THIS_YEAR), fiscal_year2(day)),
        F.when(low.rlike(NEXT_YEAR), fiscal_year2(day) + 1),
    )


def part_of_year(text: Column) -> Column:
    """'Q1'..'Q4', 'H1', 'H2' a free text names, quarters before halves; null for none."""
    low = F.lower(text)
    out = F.when(low.rlike(r"\bq[1-4]\b"), F.concat(F.lit("Q"), F.regexp_extract(low, r"\bq([1-4])\b", 1)))
    word = F.regexp_extract(low, r"\b(first|1st|second|2nd|third|3rd|fourth|4th)\s+quarter\b", 1)
    for n, words in enumerate((("first", "1st"), ("second", "2nd"), ("third", "3rd"), ("fourth", "4th")), 1):
        out = out.when(word.isin(*words), F.lit(f"Q{n}"))
    return out.when(low.rlike(r"\bh1(?:\b|fy)|\bfirst\s+half\b"), F.lit("H1")).when(low.rlike(r"\bh2(?:\b|fy)|\bsecond\s+half\b"), F.lit("H2"))


def normalize_timeline(raw: Column, day: Column) -> Column:
    """A free timeline as 'FY27', 'H1 FY27' or 'Q3 FY27', relative words counted from a day; other texts come back trimmed."""
    label = lambda part, year: F.concat(part, F.lit("FY"), F.lpad(year.cast("string"), 2, "0"))

    def told(t: Column) -> Column:
        s, low, fy, q, year, part = (t[c] for c in ("s", "low", "fy", "q", "year", "part"))
        next_q = q % 4 + 1
        n = _int(F.substring(part, 2, 1))
        last_q = F.when(part.startswith("H"), n * 2).otherwise(n)
        named = F.concat(part, F.lit(" "))
        return (
            F.when(s == "", s)
            .when(low.rlike(r"\b(next|coming|upcoming)\s+quarter\b"), label(F.concat(F.lit("Q"), next_q.cast("string"), F.lit(" ")), F.when(next_q > q, fy).otherwise(fy + 1)))
            .when(low.rlike(r"\b(this|current)\s+quarter\b"), label(F.concat(F.lit("Q"), q.cast("string"), F.lit(" ")), fy))
            .when(year.isNotNull(), label(F.coalesce(named, F.lit("")), year))
            .when(part.isNotNull(), label(named, F.when(last_q >= q, fy).otherwise(fy + 1)))
            .otherwise(s)
        )

    s = F.trim(raw)
    parts = F.struct(s.alias("s"), F.lower(s).alias("low"), fiscal_year2(day).alias("fy"), fiscal_quarter(day).alias("q"), year2(s, day).alias("year"), part_of_year(s).alias("part"))
    return let(parts, told)


def years_spanned(timeline: Column) -> Column:
    """All fiscal years of a timeline as an array, ranges filled; empty if it names none."""
    t = F.upper(F.coalesce(timeline, F.lit("")))
    named = F.transform(F.regexp_extract_all(t, F.lit(r"FY\s*(\d{2,4})"), F.lit(1)), lambda y: century(y.cast("int")))
    bare = F.transform(F.regexp_extract_all(F.regexp_replace(t, r"FY\s*\d{2,4}", " "), F.lit(r"\b(20\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    years = F.concat(named, bare)
    return F.when(F.size(years) > 0, F.sequence(F.array_min(years), F.array_max(years))).otherwise(F.array().cast("array<int>"))


def usdinr_on(day: Column) -> Column:
    """Rupees for a dollar in the calendar quarter of an ISO date text; dates outside the list take its ends, other texts the default."""
    y, m = _int(F.substring(F.trim(day), 1, 4)), _int(F.substring(F.trim(day), 6, 2))
    at = (y - USDINR_FIRST_YEAR) * 4 + F.floor((m - 1) / 3).cast("int")
    rates = F.array(*map(F.lit, USDINR))
    clamped = F.least(F.greatest(at, F.lit(0)), F.lit(len(USDINR) - 1))  # these two skip nulls
    return F.when(at.isNotNull(), F.element_at(rates, clamped + 1)).otherwise(F.lit(USDINR_DEFAULT))


def detect_quarter(text: Column) -> Column:
    """struct(quarter, fy) a title names: 'Q4 FY24', 'third quarter ... FY23-24', 'quarter ended March 31, 2024'."""
    t = F.lower(text)
    fy = TITLE_YEAR
    two = lambda y: F.concat(F.lit("FY"), F.right(y, F.lit(2)))
    direct_q, direct_y = (_found(t, rf"\bq([1-4])\b\s*(?:&|and)?\s*{fy}", g) for g in (1, 2))
    word = F.regexp_extract(t, r"\b(first|second|third|fourth)\s+quarter", 1)
    spoken = F.when(word == "first", 1).when(word == "second", 2).when(word == "third", 3).when(word == "fourth", 4)
    ended = r"ended\s+(?:on\s+)?(\w+)\s+\d{0,2},?\s*(\d{4})"
    month, year = F.regexp_extract(t, ended, 1), _int(_found(t, ended, 2))
    by_month = F.lit(None).cast("int")
    for name, n in QUARTER_ENDS.items():
        by_month = F.when(month == name, n).otherwise(by_month)
    end_year = F.when(month == "march", year).otherwise(year + 1)
    spoken_y = _found(t, fy)
    q = F.when(direct_q.isNotNull(), direct_q.cast("int")).when(by_month.isNotNull() & year.isNotNull(), F.coalesce(spoken, by_month)).when(spoken.isNotNull() & spoken_y.isNotNull(), spoken)
    y = F.when(direct_q.isNotNull(), two(direct_y)).when(by_month.isNotNull() & year.isNotNull(), two(end_year.cast("string"))).when(spoken.isNotNull(), two(spoken_y))
    return F.struct(F.concat(F.lit("Q"), q.cast("string")).alias("quarter"), F.when(q.isNotNull(), y).alias("fy"))
