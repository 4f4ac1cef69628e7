"""The most similar texts, where all texts share most of their words."""

from pyspark.sql import functions as F

from lodestar.operators import resolve, similar


def grams(text):
    return {w[i : i + 3] for x in text.split() for w in [f"  {x} "] for i in range(len(w) - 2)}


def similarity(a, b):
    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def numbered(spark, column, n):
    return spark.range(n).select(F.concat(F.lit("supplier "), F.lpad(F.col("id").cast("string"), 9, "0")).alias(column), "id")


def test_only_the_nearest_are_paired(spark):
    n = 300
    q, texts = numbered(spark, "q", n), numbered(spark, "text", n)
    pairs = similar.nearest(q, texts, lambda pairs: pairs.where("q <> text").groupBy("q").count().where("count >= 1").select("q"))
    assert pairs.select("q").distinct().count() == n
    assert pairs.count() < n * n // 5  # every pair has 0.3 in common


def test_candidates_equal_all_pairs(spark):
    names = [f"supplier {i:09d}" for i in range(0, 400, 7)] + ["plum 12", "supplier", "other words"]
    companies = [(i, f"Supplier {i // 2:09d}") for i in range(300)] + [(1000, "other word"), (1, "supplier 7")]
    got = resolve.candidates(spark.createDataFrame([(x,) for x in names], "sponsor string"), spark.createDataFrame(companies, "company_id long, name string"), 4)
    want = set()
    for x in names:
        best = {}
        for i, name in companies:
            s = similarity(x, name.lower())
            if s >= 0.3:
                best[i] = max(best.get(i, (0, "")), (s, name))
        for rank, (i, (s, name)) in enumerate(sorted(best.items(), key=lambda e: (-e[1][0], e[0]))[:4], 1):
            want.add((x, i, name, round(s, 9), rank))
    assert {(r["sponsor"], r["company_id"], r["name"], round(r["sim"], 9), r["rank"]) for r in got.collect()} == want
