"""Contained names against plain search, and the review queue at its limits."""

from pyspark.sql import functions as F

from lodestar.operators import review

QUEUE = "rq_id long, run_id string, nct_id string, sponsor string, candidates array<struct<company_id:long,p:double>>, created_at int"


def test_containing_equals_plain_search(spark):
    texts = ["abcabc", "ab", "xabcx", "été abc", "", None, "a%c", "aaaa", "abc", "abc"]
    sought = ["abc", "b", "ab", "%", "", None, "bca", "zz", "té ", "aaa", "aaaaa"]
    t, q = spark.createDataFrame([(x,) for x in texts], "text string"), spark.createDataFrame([(x,) for x in sought], "q string")
    got = {tuple(r) for r in review.containing(q, t).collect()}
    assert got == {(a, b) for a in sought if a for b in texts if b and a in b}


def test_candidates_prefer_aliases_that_begin_alike(spark):
    companies = spark.createDataFrame([(1, "Nova Bio"), (2, "Supernova"), (3, "Other"), (4, "Novartis"), (5, None)], "company_id int, name string")
    aliases = spark.createDataFrame([(3, "nova labs"), (3, "x"), (4, None)], "company_id int, alias string")
    sponsors = spark.createDataFrame([("nova",), ("nova",), ("",), (None,)], "sponsor string")
    rows = review.containment_candidates(sponsors, companies, aliases).orderBy("rank").collect()
    assert [(r.company_id, r.alias_prefix_hit) for r in rows] == [(3, 1), (1, 0), (4, 0), (2, 0)]
    assert review.containment_candidates(sponsors.limit(0), companies, aliases).count() == 0
    assert review.containment_candidates(sponsors, companies, aliases.limit(0), k=1).count() == 1


def test_accepting_and_rejecting(spark):
    q = spark.createDataFrame([(1, "r", "N1", "Acme, Inc.", [(9, 0.2), (8, None), (7, 0.2)], 2), (2, "r", "N2", None, None, 1), (3, "r", "N3", "Beta", [], 3)], QUEUE)
    choices = spark.createDataFrame([(1, 9, "x"), (1, 5, "y"), (2, 4, "x"), (99, 1, "x")], "rq_id long, company_id long, decided_by string")
    aliases = spark.createDataFrame([], "company_id long, alias string")
    decisions, new, left = review.accept(q, choices, aliases, F.lit("run"))
    assert sorted((r.nct_id, r.company_id, r.decided_by) for r in decisions.collect()) == [("N1", 5, "y"), ("N2", 4, "x")]
    assert [(r.company_id, r.alias, r.alias_type) for r in new.collect()] == [(5, "Acme, Inc.", "legal")]
    assert [r.rq_id for r in left.collect()] == [3]
    trials = spark.createDataFrame([("N1", None, "a"), ("N9", 3, "b")], "nct_id string, sponsor_company_id long, other string")
    assert sorted(map(tuple, review.apply_to_trials(trials, decisions).collect())) == [("N1", 5, "a"), ("N9", 3, "b")]
    ids = spark.createDataFrame([(1,), (2,), (3,), (3,)], "rq_id long")
    labels, left = review.reject(q, ids, label=True)
    assert [(r.nct_id, r.company_id, r.is_match) for r in labels.collect()] == [("N1", 9, False)] and left.count() == 0
    assert review.reject(q, ids)[0].count() == 0
    assert [r.rq_id for r in review.pending(q, 2).collect()] == [2, 1]
