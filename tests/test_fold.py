"""Names folded to ASCII as the compatibility form has it, and ranges that close once."""

import datetime as dt
import unicodedata

from lodestar.functions import text as T
from lodestar.operators import tables
from pyspark.sql import functions as F


def test_fold_equals_the_compatibility_form(spark):
    letters = "".join(chr(c) for c in [*range(0x20, 0x24F), *range(0x1E00, 0x1EFF), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5E)])
    texts = ["Kőbánya Škoda", "ŁÓDŹ Straße Ærø", "ﬁne ﬄ Ĳssel ½", "Ａｃｍｅ　Ｃｏｒｐ", "é é", "🎉ﬁ🎉 日本 ℃", "", letters, *letters]
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None)]
    got = {r["i"]: r["f"] for r in spark.createDataFrame(rows, "i int, t string").select("i", T.ascii_fold(F.col("t")).alias("f")).collect()}
    assert got.pop(-1) is None
    for i, t in enumerate(texts):
        assert got[i] == unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), t
    assert spark.range(1).select(T.norm_name(F.lit("Kőbánya Škoda"))).first()[0] == "kobanya skoda"


def test_a_range_closes_once_and_never_before_it_began(spark):
    day = lambda n: dt.date(2024, 5, n)
    ranges = spark.createDataFrame([("a", day(10), None, "active"), ("b", day(10), None, "active"), ("c", day(1), day(2), "delisted")], "k string, valid_from date, valid_to date, status string")
    closings = spark.createDataFrame([("a", day(20)), ("a", day(15)), ("a", day(15)), ("b", day(1)), ("b", day(10)), ("c", day(9)), ("d", day(9))], "k string, end date")
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["status"]) for r in tables.close_ranges(ranges, "k", closings).collect() if r["k"] != "b")
    assert got == [("a", day(10), day(15), "delisted"), ("a", day(15), day(15), "delisted"), ("c", day(1), day(2), "delisted")]
    assert tables.close_ranges(ranges, "k", closings).where("k = 'b'").select("valid_to", "status").collect() == [(None, "active")]
