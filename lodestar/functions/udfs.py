"""The few functions that Spark has no expression for, as Arrow-batched pandas UDFs."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.sources import html as pages

SPANS = T.ArrayType(T.StructType([T.StructField("value", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
SECTIONS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("level", "title", "body")]))


def jaro(s: str, t: str) -> float:
    if s == t:
        return 1.0
    if not s or not t:
        return 0.0
    reach = max(max(len(s), len(t)) // 2 - 1, 0)
    free = [True] * len(t)
    left = []
    for i, ch in enumerate(s):
        for j in range(max(0, i - reach), min(len(t), i + reach + 1)):
            if free[j] and t[j] == ch:
                free[j] = False
                left.append(ch)
                break
    if not left:
        return 0.0
    right = [c for c, f in zip(t, free, strict=True) if not f]
    swapped = sum(a != b for a, b in zip(left, right, strict=True)) // 2
    m = len(left)
    return (m / len(s) + m / len(t) + (m - swapped) / m) / 3


def jaro_winkler_text(s: str, t: str) -> float:
    """Jaro with a bonus of a tenth of the rest for each of the first four characters that agree, at any
    level of similarity."""
    j, same = jaro(s, t), 0
    while same < min(4, len(s), len(t)) and s[same] == t[same]:
        same += 1
    return j + same * 0.1 * (1 - j)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if s is None or t is None else jaro_winkler_text(s, t) for s, t in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the characters in common blocks over all characters, blocks found longest first."""
    return pd.Series([SequenceMatcher(None, s or "", t or "").ratio() for s, t in zip(a, b, strict=True)], dtype="float64")


def regex_spans(*patterns: str):
    """A UDF: text -> array of (value, start, end), 0-based, end excluded, of every pattern on its own."""
    import re

    compiled = [re.compile(p) for p in patterns]

    @F.pandas_udf(SPANS)
    def spans(text: pd.Series) -> pd.Series:
        return pd.Series([[{"value": m.group(), "start": m.start(), "end": m.end()} for c in compiled for m in c.finditer(t or "")] for t in text])

    return spans


@F.pandas_udf(SECTIONS)
def html_sections(html: pd.Series) -> pd.Series:
    """Headings and the text that follows each, of an HTML page."""
    return pd.Series([[{"level": a, "title": b, "body": c} for a, b, c in pages.sections(h or "")] for h in html])


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    """Visible text of an HTML page."""
    return pd.Series([pages.visible_text(h or "") for h in html])
