"""Dates and readout windows in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# Congress windows as (name, first month and day, last month and day).
CONGRESSES = (("ESMO", (9, 15), (9, 20)), ("ASCO", (6, 1), (6, 5)), ("ASH", (12, 5), (12, 9)))
# Weights of window kinds.
WEIGHTS = {"exact": 0.95, "quarter": 0.6, "half": 0.6, "year": 0.6, "conference": 0.8}


def parse_date(s: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy-MM", "MM/dd/yyyy", "yyyyMMdd", "MMMM d, yyyy")) -> Column:
    """The first format that fits; a month alone is its first day; else null."""
    return F.coalesce(*(F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in formats))


def text_window(s: Column) -> Column:
    """Window struct (start, end, weight, kind) that a text names, or null.

    Tried in this order: an exact day, a quarter, a half, a bare year, a congress; so a congress with
    its year counts as the year.
    """

    def group(pattern: str, k: int) -> Column:
        return F.regexp_extract(s, pattern, k)

    def window(start: Column, end: Column, kind: str) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), F.lit(WEIGHTS[kind]).alias("weight"), F.lit(kind).alias("kind"))

    exact = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+(\d{1,2}),?\s+(20\d\d)\b"
    month = F.coalesce(*(F.when(F.lower(group(exact, 1)) == m, i) for i, m in enumerate(MONTHS, 1)))
    day = F.try_make_timestamp(group(exact, 3).try_cast("int"), month, group(exact, 2).try_cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    quarter, half, year = r"(?i)\bQ([1-4])\s+(20\d\d)\b", r"(?i)\bH([12])\s+(20\d\d)\b", r"\b(20\d\d)\b"
    q, qy = group(quarter, 1).try_cast("int"), group(quarter, 2).try_cast("int")
    h, hy = group(half, 1).try_cast("int"), group(half, 2).try_cast("int")
    y = group(year, 1).try_cast("int")
    q_end = F.last_day(F.make_date(qy, q * 3, F.lit(1)))
    h_end = F.last_day(F.make_date(hy, h * 6, F.lit(1)))
    return (
        F.when(day.isNotNull(), window(F.date_sub(day, 1), F.date_add(day, 2), "exact"))
        .when(q.isNotNull(), window(F.make_date(qy, q * 3 - 2, F.lit(1)), q_end, "quarter"))
        .when(h.isNotNull(), window(F.make_date(hy, h * 6 - 5, F.lit(1)), h_end, "half"))
        .when(y.isNotNull(), window(F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31)), "year"))
    )


def congress_window(name: Column, year: Column) -> Column:
    """Window of a congress, from two days before to one after; unknown ones are in early June."""
    start = end = None
    for congress, (m1, d1), (m2, d2) in CONGRESSES:
        hit = F.upper(name) == congress
        first, last = F.make_date(year, F.lit(m1), F.lit(d1)), F.make_date(year, F.lit(m2), F.lit(d2))
        start = F.when(hit, first) if start is None else start.when(hit, first)
        end = F.when(hit, last) if end is None else end.when(hit, last)
    start, end = start.otherwise(F.make_date(year, F.lit(6), F.lit(1))), end.otherwise(F.make_date(year, F.lit(6), F.lit(5)))
    return F.struct(F.date_sub(start, 2).alias("start"), F.date_add(end, 1).alias("end"), F.lit(WEIGHTS["conference"]).alias("weight"), F.lit("conference").alias("kind"))
