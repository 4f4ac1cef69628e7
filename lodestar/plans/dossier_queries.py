"""Queries over study cards, decisions, listings and corporate families, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import dossier
from lodestar.plans import adapters as A
from lodestar.plans.entity_queries import COMPANIES, NORM, WORDING

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


SPANS = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'p1' END AS l1, CASE WHEN o_orderkey % 2 = 0 THEN 'text' ELSE '' END AS t1, CASE WHEN o_orderkey % 5 = 0 THEN 'p2' END AS l2, o_orderkey % 7 = 0 AS none, CASE o_orderkey % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'med' WHEN 2 THEN 'low' ELSE 'odd' END AS level FROM orders"


@query(f"WITH s AS ({SPANS}) SELECT id, round(CASE WHEN none THEN 0 ELSE (CASE WHEN l1 IS NOT NULL THEN 6e-1 ELSE 0 END + CASE WHEN t1 <> '' THEN 4e-1 ELSE 0 END + CASE WHEN l2 IS NOT NULL THEN 6e-1 ELSE 0 END) / 2 END, 6) AS evidence, CASE level WHEN 'HIGH' THEN 1e0 WHEN 'med' THEN 7e-1 WHEN 'low' THEN 4e-1 ELSE 5e-1 END AS coverage FROM s")
def qc3_evidence_quality(spark, sf_dir):
    span = lambda a, b: F.struct(a.alias("loc"), b.alias("text_preview"))
    s = A.select(spark, sf_dir, SPANS, "orders").withColumn("spans", F.when(~F.col("none"), F.array(span(F.col("l1"), F.col("t1")), span(F.col("l2"), F.lit(None).cast("string")))))
    return s.select("id", F.round(dossier.evidence_quality(F.col("spans")), 6).alias("evidence"), dossier.coverage_quality(F.col("level")).alias("coverage"))


RISKS = "SELECT o_orderkey AS id, CAST(o_orderkey % 3 AS INT) AS late, CASE o_orderkey % 4 WHEN 0 THEN 65e-2 WHEN 1 THEN 8e-1 END AS power, CAST(o_orderkey % 200 AS INT) AS patients, o_orderkey % 5 = 0 AS sub_win, o_orderkey % 2 = 0 AS primary_win, o_orderkey % 3 = 1 AS both_defined, CASE WHEN o_orderkey % 7 < 3 THEN 'PP' ELSE 'ITT' END AS analysed_on FROM orders"


@query(f"WITH r AS ({RISKS}) SELECT id, concat_ws('; ', CASE WHEN late > 0 THEN 'Protocol change after LPR (S1)' END, CASE WHEN late > 1 THEN 'Protocol change after LPR (S1)' END, CASE WHEN power IS NULL THEN CASE WHEN patients < 100 THEN 'Small sample size: ' || patients END WHEN power < 7e-1 THEN 'Underpowered study (power: 0.65)' END, CASE WHEN sub_win AND NOT primary_win THEN 'Subgroup-only win without primary success' END, CASE WHEN both_defined AND analysed_on = 'PP' THEN 'Primary analysis on PP population instead of ITT' END) AS factors FROM r")
def qc4_risk_factors(spark, sf_dir):
    r = A.select(spark, sf_dir, RISKS, "orders")
    c = [F.col(x) for x in ("late", "power", "patients", "sub_win", "primary_win", "both_defined", "analysed_on")]
    c[1], c[3] = c[1].cast("double"), F.array(c[3])
    return r.select("id", F.array_join(dossier.risk_factors(*c), "; ").alias("factors"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <= 3 THEN CAST(trunc(1 + (o_orderkey % 101) * 30 / 100) AS INT) WHEN o_orderkey % 10 <= 6 THEN CAST(trunc(31 + (o_orderkey % 101) * 30 / 100) AS INT) ELSE CAST(trunc(61 + (o_orderkey % 101) * 39 / 100) AS INT) END AS score FROM orders")
def ct11_fallback_score(spark, sf_dir):
    o = A.tables(spark, sf_dir, "orders")["orders"]
    quality = (F.col("o_orderkey") % 101).cast("decimal(10,2)") / F.lit(100).cast("decimal(10,2)")
    return o.select(F.col("o_orderkey").alias("id"), dossier.fallback_score(F.col("o_orderkey") % 10, quality).alias("score"))


@query("SELECT l_orderkey AS id, l_linenumber AS n, CASE l_linenumber % 5 WHEN 0 THEN 1e0 WHEN 1 THEN 9e-1 WHEN 2 THEN 85e-2 WHEN 3 THEN 95e-2 ELSE 5e-1 END AS confidence FROM lineitem")
def tx14_link_confidence(spark, sf_dir):
    kind = F.element_at(F.array(*(F.lit(x) for x in ("nct_near_asset", "code_in_text", "inn_in_text", "exact_intervention_match", "other"))), (F.col("l_linenumber") % 5 + 1).cast("int"))
    rows = A.tables(spark, sf_dir, "lineitem")["lineitem"].select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), kind.alias("k"))
    return rows.select("id", "n", dossier.link_confidence(F.col("k"), F.lit(0.5)).alias("confidence"))


COUNT = {k: " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in v) for k, v in (("a", dossier.CAUTIOUS_WORDS), ("b", dossier.DEFINITIVE_WORDS))}


@query(f"WITH d AS ({WORDING}), n AS (SELECT doc_id, {COUNT['a']} AS a, {COUNT['b']} AS b FROM d) SELECT doc_id, CASE WHEN b > a THEN 'definitive' WHEN a > b THEN 'cautious' ELSE 'neutral' END AS tone FROM n")
def tx23_simple_tone(spark, sf_dir):
    return A.select(spark, sf_dir, WORDING, "customer").select("doc_id", dossier.simple_tone(F.col("text")).alias("tone"))


@query("WITH p AS (SELECT l_orderkey AS id, min(l_returnflag) AS a, max(l_returnflag) AS b, min(l_linestatus) AS c, max(l_linestatus) AS d, CAST(min(l_quantity) AS INT) AS e, CAST(max(l_quantity) AS INT) AS f FROM lineitem GROUP BY 1) SELECT id, concat_ws(',', CASE WHEN a <> b THEN 'briefTitle' END, CASE WHEN c <> d THEN 'phase' END, CASE WHEN e <> f THEN 'sampleSize' END, 'analysisPlan') AS changed, CAST(CASE WHEN c <> d THEN 1 ELSE 0 END + CASE WHEN e <> f THEN 1 ELSE 0 END AS INT) AS significant FROM p")
def ch9_field_changes(spark, sf_dir):
    p = A.tables(spark, sf_dir, "lineitem")["lineitem"].groupBy(F.col("l_orderkey").alias("id")).agg(*(f(c).alias(f"{n}_{c}") for c in ("l_returnflag", "l_linestatus", "l_quantity") for f, n in ((F.min, "a"), (F.max, "b"))))
    none = F.lit(None).cast("string")
    side = lambda s, plan: {"briefTitle": F.col(f"{s}_l_returnflag"), "officialTitle": none, "phase": F.col(f"{s}_l_linestatus"), "status": F.lit("x"), "sampleSize": F.col(f"{s}_l_quantity"), "primaryEndpoint": none, "analysisPlan": plan}
    c = p.select("id", dossier.field_changes(side("a", none), side("b", F.lit("new"))).alias("c"))
    return c.select("id", F.array_join(F.transform("c.changes", lambda x: x["field"]), ",").alias("changed"), F.col("c.significant_count").alias("significant"))


@query("SELECT c_custkey AS sponsor, CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1 WHEN c_custkey % 2 = 0 AND c_custkey % 5 <> 0 THEN c_custkey END AS company_id, CASE WHEN c_custkey % 3 = 0 THEN 'deterministic:name_strict' WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 5 = 0 THEN 'probabilistic:reject' ELSE 'probabilistic:accept' END ELSE 'no_match' END AS match_type, CASE WHEN c_custkey % 3 = 0 THEN 1e0 WHEN c_custkey % 2 = 0 THEN 5e-1 ELSE 0e0 END AS p_match, CASE WHEN c_custkey % 3 = 0 THEN 1e0 WHEN c_custkey % 2 = 0 THEN 25e-2 ELSE 0e0 END AS top2_margin FROM customer")
def er8_resolve_all(spark, sf_dir):
    s = A.tables(spark, sf_dir, "customer")["customer"].select(F.col("c_custkey").alias("sponsor"))
    det = s.where("sponsor % 3 = 0").select("sponsor", (F.col("sponsor") + 1).alias("company_id"), F.lit("name_strict").alias("step"))
    mode = F.when(F.col("sponsor") % 5 == 0, "reject").otherwise("accept")
    prob = s.where("sponsor % 2 = 0").select("sponsor", mode.alias("mode"), F.when(mode == "accept", F.col("sponsor")).alias("company_id"), F.lit(0.5).alias("p"), F.lit(0.25).alias("margin"))
    return dossier.resolve_all(s, det, prob)


GRAMS = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array({0}, '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
SAID = "SELECT DISTINCT CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) WHEN s_suppkey % 3 = 1 THEN replace(s_name, '#', ' ') ELSE 'Plum ' || CAST(s_suppkey AS VARCHAR(20)) END AS name FROM supplier"


@query(f"WITH s AS ({SAID}), o AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9_ ]', '', 'g') AS k FROM s), c AS (SELECT s_suppkey AS company_id, replace(s_name, '#', CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '#' END) AS name FROM supplier), e AS (SELECT o.name, min(company_id) AS same FROM o JOIN c ON k = lower(c.name) GROUP BY 1), a AS (SELECT DISTINCT k, unnest({GRAMS.format('k')}) AS t, len({GRAMS.format('k')}) AS na FROM o), b AS (SELECT company_id, unnest({GRAMS.format('lower(name)')}) AS t, len({GRAMS.format('lower(name)')}) AS nb FROM c), m AS (SELECT k, company_id, count(*) / CAST(any_value(na) + any_value(nb) - count(*) AS DOUBLE) AS sim FROM a JOIN b USING (t) GROUP BY 1, 2 HAVING count(*) / CAST(any_value(na) + any_value(nb) - count(*) AS DOUBLE) >= 3e-1), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sim DESC, company_id) AS n FROM m) SELECT o.name, coalesce(same, r.company_id) AS company_id, round(CASE WHEN same IS NOT NULL THEN 1e0 ELSE coalesce(sim, 0e0) END, 6) AS confidence, CASE WHEN same IS NOT NULL THEN 'exact' WHEN sim > 8e-1 THEN 'high_confidence' WHEN sim > 6e-1 THEN 'moderate_confidence' WHEN sim IS NOT NULL THEN 'low_confidence' ELSE 'uncertain' END AS match_type FROM o LEFT JOIN e USING (name) LEFT JOIN r ON r.k = o.k AND n = 1")
def er3c_fuzzy_companies(spark, sf_dir):
    companies = A.tables(spark, sf_dir, "supplier")["supplier"].select(F.col("s_suppkey").alias("company_id"), F.when(F.col("s_suppkey") % 2 == 0, F.replace("s_name", F.lit("#"), F.lit(""))).otherwise(F.col("s_name")).alias("name"))
    out = dossier.fuzzy_companies(A.select(spark, sf_dir, SAID, "supplier"), companies)
    return out.withColumn("confidence", F.round("confidence", 6))


@query("WITH f AS (SELECT DISTINCT l_suppkey AS nct_id, l_linenumber AS run_id, l_partkey AS company_id FROM lineitem), m AS (SELECT nct_id, max(run_id) AS run_id FROM f GROUP BY 1) SELECT f.* FROM f JOIN m USING (nct_id, run_id)")
def ag23_latest_run(spark, sf_dir):
    f = A.tables(spark, sf_dir, "lineitem")["lineitem"].select(F.col("l_suppkey").alias("nct_id"), F.col("l_linenumber").alias("run_id"), F.col("l_partkey").alias("company_id")).distinct()
    return dossier.latest_run(f, ["nct_id"]).select("nct_id", "run_id", "company_id")


@query("SELECT o_custkey AS nct_id, o_orderkey AS decision FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) x WHERE n = 1")
def w7_latest_decision(spark, sf_dir):
    d = A.tables(spark, sf_dir, "orders")["orders"].select(F.col("o_custkey").alias("nct_id"), "o_orderdate", F.col("o_orderkey").alias("decision"))
    return dossier.latest_row(d, ["nct_id"], ["o_orderdate", "decision"]).select("nct_id", "decision")


@query("WITH c AS (SELECT DISTINCT l_suppkey % 10 AS sponsor_norm, l_partkey % 20 AS company_id FROM lineitem), d AS (SELECT o_custkey % 10 AS s, o_orderkey % 20 AS c, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2), t AS (SELECT c_nationkey AS c, count(*) AS n FROM customer GROUP BY 1) SELECT sponsor_norm, company_id, coalesce(d.n, 0) AS prior_accepts, coalesce(t.n, 0) AS linked_trials FROM c LEFT JOIN d ON d.s = sponsor_norm AND d.c = company_id LEFT JOIN t ON t.c = company_id")
def ag24_candidate_history(spark, sf_dir):
    t = A.tables(spark, sf_dir, "lineitem", "orders", "customer")
    found = t["lineitem"].select((F.col("l_suppkey") % 10).alias("sponsor_norm"), (F.col("l_partkey") % 20).alias("company_id")).distinct()
    kind = F.when(F.col("o_orderstatus") == "F", "probabilistic:accept").when(F.col("o_orderstatus") == "O", "deterministic:name_strict").otherwise("probabilistic:review")
    decided = t["orders"].select((F.col("o_custkey") % 10).alias("sponsor_norm"), (F.col("o_orderkey") % 20).alias("company_id"), kind.alias("match_type"))
    return dossier.candidate_history(found, decided, t["customer"].select(F.col("c_nationkey").alias("sponsor_company_id"))).select("sponsor_norm", "company_id", "prior_accepts", "linked_trials")


@query("SELECT c_custkey AS company_id, n_name AS exchange_code, 'M' || n_nationkey AS mic FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING' AND n_regionkey < 3")
def prj11_active_securities(spark, sf_dir):
    t = A.tables(spark, sf_dir, "customer", "nation")
    s = t["customer"].select(F.col("c_custkey").alias("company_id"), F.col("c_nationkey").alias("exchange_id"), F.when(F.col("c_mktsegment") == "BUILDING", "active").otherwise("delisted").alias("status"))
    e = t["nation"].select(F.col("n_nationkey").alias("exchange_id"), F.col("n_name").alias("code"), F.concat(F.lit("M"), F.col("n_nationkey").cast("string")).alias("mic"), (F.col("n_regionkey") < 3).alias("is_allowed"))
    return dossier.active_securities(s, e).select("company_id", "exchange_code", "mic")


@query("SELECT o_orderkey AS study_id, CAST(o_orderkey % 10 AS INT) AS score_1_10 FROM orders WHERE o_orderkey % 10 <= 5 AND o_orderstatus <> 'P' ORDER BY o_orderkey % 10, o_custkey, o_orderkey LIMIT 100")
def prj13_low_quality(spark, sf_dir):
    o = A.tables(spark, sf_dir, "orders")["orders"]
    rankings = o.select(F.col("o_orderkey").alias("trial_id"), F.when(F.col("o_orderstatus") == "P", "human").otherwise("auto_quality").alias("evaluator_id"), (F.col("o_orderkey") % 10).cast("int").alias("score_1_10"), F.col("o_custkey").alias("confidence_level"))
    return dossier.low_quality(o.select(F.col("o_orderkey").alias("trial_id"), F.col("o_orderkey").alias("study_id")), rankings).select("study_id", "score_1_10")


@query("WITH m AS (SELECT o_orderkey AS dataset, o_orderdate AS ts, o_orderkey % 100 AS s, o_orderkey % 50 AS c, o_orderkey % 40 + 10 AS n, o_orderkey % 7 AS f, o_orderkey % 3 AS k FROM orders WHERE o_orderdate >= DATE '1996-01-01') SELECT count(*) AS datasets, round(avg(s), 6) AS mean_score, round(avg(c), 6) AS mean_completeness, arg_max(s, {'t': ts, 'd': dataset}) AS current_score, CAST(coalesce(sum(n), 0) AS BIGINT) AS records, CAST(coalesce(sum(f), 0) AS BIGINT) AS failures, round(coalesce(sum(f) / sum(n), 0), 6) AS failure_rate, CAST(coalesce(sum(k), 0) AS BIGINT) AS critical, arg_max(k, {'t': ts, 'd': dataset}) AS current_critical FROM m")
def ag18_quality_summary(spark, sf_dir):
    k = F.col("o_orderkey")
    m = A.tables(spark, sf_dir, "orders")["orders"].select(k.alias("dataset"), F.col("o_orderdate").alias("calculated_at"), (k % 100).alias("overall_quality_score"), (k % 50).alias("completeness_score"), (k % 40 + 10).alias("total_records"), (k % 7).alias("failed_validations"), (k % 3).alias("critical_issues"))
    out = dossier.quality_summary(m, F.lit("1996-01-01").cast("timestamp_ntz"))
    return out.select("datasets", F.round("mean_score", 6).alias("mean_score"), F.round("mean_completeness", 6).alias("mean_completeness"), "current_score", "records", "failures", F.round("failure_rate", 6).alias("failure_rate"), "critical", "current_critical")


FAMILY = "SELECT s_suppkey AS company_id, 'Acme Unit ' || CAST(s_suppkey % 40 AS VARCHAR(20)) AS alias, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'acme unit ' || CAST(s_suppkey % 40 AS VARCHAR(20)) END AS alias_norm, 'subsidiary' AS alias_type FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'Acme Unit ' || CAST(s_suppkey AS VARCHAR(20)), 'acme unit ' || CAST(s_suppkey AS VARCHAR(20)), CASE WHEN s_suppkey % 3 = 0 THEN 'legal' ELSE 'aka' END FROM supplier WHERE s_suppkey < 30 UNION ALL SELECT s_suppkey, 'Acme Unit 39', 'acme unit 39', 'short' FROM supplier WHERE s_suppkey < 5"
SUBS = f"f AS ({FAMILY}), s AS (SELECT company_id AS parent_id, alias, {NORM.format('alias')} AS alias_norm FROM f WHERE alias_type = 'subsidiary'), c AS (SELECT alias_norm, company_id AS src FROM f WHERE alias_type IN ('legal', 'aka'))"


@query(f"WITH {SUBS}, e AS (SELECT DISTINCT src, parent_id AS dst FROM s JOIN c USING (alias_norm)) SELECT 'edge' AS kind, CAST(src AS VARCHAR) AS child, dst AS parent FROM e WHERE NOT (src % 4 = 0 AND dst = src) UNION ALL SELECT DISTINCT 'stub', alias_norm, parent_id FROM s WHERE alias_norm NOT IN (SELECT alias_norm FROM c)")
def er18_subsidiaries(spark, sf_dir):
    known = A.tables(spark, sf_dir, "supplier")["supplier"].where("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("src"), F.col("s_suppkey").alias("dst"))
    edges, stubs = dossier.link_subsidiaries(A.select(spark, sf_dir, FAMILY, "supplier"), known)
    return edges.select(F.lit("edge").alias("kind"), F.col("src").cast("string").alias("child"), F.col("dst").alias("parent")).unionByName(stubs.select(F.lit("stub").alias("kind"), F.col("alias_norm").alias("child"), F.col("parent_id").alias("parent")).distinct())


STATEMENTS = "SELECT s_suppkey AS company_id, CASE s_suppkey % 4 WHEN 0 THEN 'Acme (formerly known as Old Bolt ' || CAST(s_suppkey AS VARCHAR(20)) || ' Inc.) makes it.' WHEN 1 THEN 'We, doing business as Kite Works ' || CAST(s_suppkey AS VARCHAR(20)) || ' in Ohio.' WHEN 2 THEN 'Blue Lab ' || CAST(s_suppkey AS VARCHAR(20)) || ' is a wholly-owned subsidiary of Acme.' ELSE 'Nothing of the kind' END AS body FROM supplier"


@query(f"WITH d AS ({STATEMENTS}) SELECT company_id, CASE company_id % 4 WHEN 0 THEN 'former_name' WHEN 1 THEN 'dba' ELSE 'subsidiary' END AS alias_type, lower(CASE company_id % 4 WHEN 0 THEN 'old bolt ' || company_id || ' inc' WHEN 1 THEN 'Kite Works ' || company_id ELSE 'Blue Lab ' || company_id END) AS alias_norm FROM d WHERE company_id % 4 <> 3")
def er20_names_in_text(spark, sf_dir):
    return dossier.names_in_text(A.select(spark, sf_dir, STATEMENTS, "supplier"), "company_id", "body").select("company_id", "alias_type", "alias_norm")


@query(f"WITH c AS ({COMPANIES}) SELECT s_suppkey AS company_id, 'd' || s_suppkey || '.example.org' AS domain, 'alias' AS origin FROM supplier WHERE s_suppkey % 6 = 0 UNION ALL SELECT company_id, website_domain, 'website' FROM c WHERE website_domain IS NOT NULL")
def st2_domain_view(spark, sf_dir):
    s = A.tables(spark, sf_dir, "supplier")["supplier"]
    aliases = s.where("s_suppkey % 6 = 0").select(F.col("s_suppkey").alias("company_id"), F.concat(F.lit("D"), F.col("s_suppkey").cast("string"), F.lit(".Example.org")).alias("alias"), F.lit("domain").alias("alias_type"))
    return dossier.domain_view(aliases, A.select(spark, sf_dir, COMPANIES, "supplier"))
