"""Similar names against all pairs, candidates by halves, and the whole job."""

import random
import re

import pytest
from lodestar.operators import resolution, resolve
from pyspark.sql import functions as F


def grams(s):
    return {p[i : i + 3] for w in re.findall("[a-z0-9]+", s.lower()) for p in [f"  {w} "] for i in range(len(p) - 2)}


def similarity(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def names(seed, n):
    r = random.Random(seed)
    words = ["pharma", "bio", "therapeutics", "acme", "zeta", "corp", "labs", "onco", "gen", "x", "nova", "inc", "vax"]
    out = [" ".join(r.choice(words) + r.choice(["", "", "s", "ix"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return sorted({*out, "", "--", "é", "a", "A", "pharma", "Pharma Pharma"})


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8, 1.0])
def test_similar_texts_equal_all_pairs(spark, least):
    a, b = names(1, 60), names(2, 80)
    q = spark.createDataFrame([(x,) for x in [*a, None, a[5]]], "q string").repartition(3)
    t = spark.createDataFrame([(x,) for x in [*b, None, b[5]]], "text string")
    got = sorted((r["q"], r["text"], round(r["sim"], 9)) for r in resolution.similar_texts(q, t, least).collect())
    assert got == sorted((x, y, round(similarity(x, y), 9)) for x in a for y in b if grams(x) and similarity(x, y) >= least)


def test_filters_leave_few_pairs(spark):
    r = random.Random(4)
    token = lambda: "".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(7))
    texts = [f"{token()} {token()} pharma" for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in texts], "q string")
    met = resolution._met(df, df.withColumnRenamed("q", "text"), 0.5).count()
    every = sum(bool(grams(x) & grams(y)) for x in texts for y in texts)
    assert every == 160_000 and met < 4_000  # all share a word


def tables(spark):
    companies = spark.createDataFrame([(1, "Acme Pharma Inc", "acme.com"), (2, "Zeta Bio", None), (3, "Zeta Biologics", ""), (4, "Other Labs", "other.org")], "company_id long, name string, website_domain string")
    aliases = spark.createDataFrame([(2, "Zeta Biosciences", "aka"), (2, "www.zeta.io", "domain"), (2, None, "domain"), (4, "Zeta Bio Labs", "former"), (1, "Acme", "aka")], "company_id long, alias string, alias_type string")
    securities = spark.createDataFrame([(2, "ZBIO", "NYSE"), (2, "ZB", "NASDAQ"), (4, "OTH", None)], "company_id long, ticker string, exchange string")
    return companies, aliases, securities


def test_halves_and_metadata(spark):
    found = resolution.retrieve(spark.createDataFrame([("Zeta Bio",), (None,), ("zz qq",)], "sponsor string"), *tables(spark), k=2).collect()
    assert [(r["sponsor"], r["company_id"], r["rank"]) for r in sorted(found, key=lambda r: r["rank"])] == [("Zeta Bio", 2, 1), ("Zeta Bio", 4, 2)]
    by = {r["company_id"]: r for r in found}
    assert (by[2]["ticker"], by[2]["domains"], by[2]["website_domain"]) == ("ZB", ["zeta.io"], "")
    assert (by[4]["ticker"], by[4]["exchange"]) == ("OTH", None) and by[4]["sim"] == pytest.approx(similarity("zeta bio", "zeta bio labs"))


def trials(spark):
    rows = [("n1", "Acme Pharma Inc", 0, None, None), ("n2", "Zeta Bio company", None, ["zeta.io"], True), ("n3", "University of X", 0, None, None), ("n4", None, 0, None, None), ("n5", "Acme Pharma Inc", 7, None, None), ("n6", "Rule Me Please", 0, None, None), ("n7", "Zeta Bio company", 0, None, None), ("n8", "qqq", 0, None, None)]
    return spark.createDataFrame(rows, "nct_id string, sponsor_text string, sponsor_company_id long, context_domains array<string>, drug_code_hit boolean")


def run(spark, open_trials, companies, aliases, securities):
    rules = spark.createDataFrame([(1, "rule me", 4, 1)], "rule_id int, pattern string, company_id long, priority int")
    ignore = spark.createDataFrame([("^univ",)], "pattern string")
    return resolution.resolve_trials(open_trials, companies, aliases, securities, rules, ignore, F.lit("r1"), tau=0.8, low=0.2)


def test_the_job_decides_keeps_and_promotes(spark):
    t, (c, a, s) = trials(spark), tables(spark)
    out = run(spark, t, c, a, s)
    got = {r["nct_id"]: (r["company_id"], r["mode"], r["method"]) for r in out["decisions"].collect()}
    # n8 has no candidate, n3 is ignored, n4 has no sponsor, n5 has its company
    assert set(got) == {"n1", "n2", "n6", "n7"}
    assert got["n1"] == (1, "accept", "det:name_strict") and got["n6"] == (4, "accept", "det:rule")
    assert got["n2"] == (2, "accept", "prob")  # its context names the company's host
    assert got["n7"][1] in ("review", "reject")
    assert {r["nct_id"] for r in out["queue"].collect()} == {n for n, (_, mode, _) in got.items() if mode == "review"}
    assert all(r["candidates"][0]["company_id"] == got[r["nct_id"]][0] for r in out["queue"].collect())
    features = out["features"].collect()
    assert {r["nct_id"] for r in features} == {"n2", "n7"} and all(f'"{k}"' in features[0]["features_jsonb"] for k in resolution.FEATURES)
    new = {(r["company_id"], r["alias"]) for r in out["aliases"].collect()}
    assert new == {(1, "Acme Pharma Inc"), (4, "Rule Me Please"), (2, "Zeta Bio company")}
    applied = {r["nct_id"]: r["sponsor_company_id"] for r in out["trials"].collect()}
    assert (applied["n1"], applied["n2"], applied["n5"], applied["n6"]) == (1, 2, 7, 4) and len(applied) == 8


def test_what_was_accepted_is_found_exactly_next_time(spark):
    t, (c, a, s) = trials(spark), tables(spark)
    one = run(spark, t, c, a, s)
    more = a.unionByName(one["aliases"].select("company_id", "alias", "alias_type"))
    again = run(spark, one["trials"], c, more, s)
    got = {r["nct_id"]: (r["company_id"], r["method"]) for r in again["decisions"].collect()}
    assert got == {"n7": (2, "det:alias_strict")} and again["aliases"].count() == 0


def test_too_many_patterns_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(resolve, "PATTERNS", 1)
    with pytest.raises(ValueError):
        resolve.not_ignored(spark.createDataFrame([("a",)], "sponsor string"), spark.createDataFrame([("x",), ("y",)], "pattern string"))
