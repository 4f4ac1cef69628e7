"""Queries over analyses, reports and change detection, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import analysis, versions
from lodestar.operators import tables as ops
from lodestar.plans import adapters as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: One row per order line group: small whole numbers that stand for counts and tenths.
STUDIES = "SELECT l_orderkey AS study_id, CAST(count(*) AS BIGINT) AS n, CAST(min(l_partkey) % 11 AS BIGINT) AS a, CAST(max(l_partkey) % 7 AS BIGINT) AS b, CAST(min(l_suppkey) % 5 AS BIGINT) AS c, CAST(max(l_linenumber) AS BIGINT) AS d FROM lineitem GROUP BY 1"


def _studies(spark, sf_dir) -> DataFrame:
    return A.select(spark, sf_dir, STUDIES, "lineitem")


@query(f"WITH s AS ({STUDIES}) SELECT study_id, round(greatest(0e0, least(1e0, 4e-1 * (a / 1e1) + 3e-1 * (b / 7e0) + 2e-1 * (c * 2e1) / 1e2 - 1e-1 * least(5e-1, d / 1e1))), 6) AS score, round(greatest(0e0, least(1e0, 4e-1 * (a / 1e1) + 3e-1 * (b / 7e0) + 2e-1 * greatest(0e0, least(1e0, (1e2 - d * 5e-1) / 1e2)) + 1e-1 * greatest(0e0, 1 - 1e-1 * c))), 6) AS confidence FROM s")
def qc8_evaluation(spark, sf_dir):
    a, b, c, d = F.col("a") / 10.0, F.col("b") / 7.0, F.col("c"), F.col("d")
    return _studies(spark, sf_dir).select("study_id", F.round(analysis.evaluation_score(a, b, c * 20.0, d / 10.0), 6).alias("score"), F.round(analysis.evaluation_confidence(a, b, d, c), 6).alias("confidence"))


@query(f"WITH s AS ({STUDIES}), v AS (SELECT study_id, greatest(0e0, least(1e2, 7e-1 * greatest(0e0, 1e2 - 25 * c - 10 * b - 2 * a) + 3e-1 * 100 * ((n + 5e-1 * b) / (n + b + 1)))) AS x FROM s) SELECT study_id, round(x, 4) AS score, CASE WHEN x >= 90 THEN 'A' WHEN x >= 80 THEN 'B' WHEN x >= 70 THEN 'C' WHEN x >= 60 THEN 'D' ELSE 'F' END AS grade FROM v")
def qc7_validation_grade(spark, sf_dir):
    a, b, c, n = (F.col(x) for x in "abcn")
    x = analysis.validation_score(c, b, a, analysis.completeness(n, b, n + b + 1))
    return _studies(spark, sf_dir).withColumn("x", x).select("study_id", F.round("x", 4).alias("score"), analysis.grade(F.col("x")).alias("grade"))


EVIDENCE = "CASE c WHEN 0 THEN 'strong' WHEN 1 THEN 'moderate' WHEN 2 THEN 'weak' ELSE 'insufficient' END"


def _evidence():
    return F.when(F.col("c") == 0, "strong").when(F.col("c") == 1, "moderate").when(F.col("c") == 2, "weak").otherwise("insufficient")


@query(f"WITH s AS ({STUDIES}), r AS (SELECT *, {EVIDENCE} AS e FROM s), q AS (SELECT study_id, a, b, d, round(greatest(0e0, least(1e0, 4e-1 * (a / 1e1) + CASE e WHEN 'strong' THEN 3e-1 WHEN 'moderate' THEN 2e-1 WHEN 'weak' THEN 1e-1 ELSE 0e0 END - 2e-1 * (b // 6) - 1e-1 * (d // 7) - 2e-2 * b)), 6) AS score FROM r) SELECT study_id, score, CASE WHEN score >= 8e-1 THEN 'excellent' WHEN score >= 6e-1 THEN 'good' WHEN score >= 4e-1 THEN 'fair' ELSE 'poor' END AS rating, round(least(1e0, 5e-1 + least(3e-1, a * 5e-2) + least(2e-1, d * 100 / 5e3) - CASE WHEN a > 20 THEN 1e-1 ELSE 0e0 END), 6) AS confidence FROM q")
def tx30_reviewer_rating(spark, sf_dir):
    s = _studies(spark, sf_dir).withColumn("e", _evidence())
    score = F.round(analysis.reviewer_score(F.col("a") / 10.0, F.col("e"), F.floor(F.col("b") / 6), F.floor(F.col("d") / 7), F.col("b")), 6)
    return s.withColumn("score", score).select("study_id", "score", analysis.reviewer_rating(F.col("score")).alias("rating"), F.round(analysis.reviewer_confidence(F.col("a"), F.col("d") * 100), 6).alias("confidence"))


@query(f"WITH s AS ({STUDIES}), k AS (SELECT study_id, a, b, c, n, d * 300 AS len, a / (d * 3e2) * 1000 AS x, b / (d * 3e2) * 1000 AS y FROM s) SELECT study_id, round(CASE WHEN len = 0 THEN 0e0 WHEN a + b = 0 THEN 3e-1 ELSE least(1e0, ((a + b) / 1e1 + (1 - abs(x - y) / greatest(x + y, 1e0)) + least(len / 1e3, 1e0)) / 3) END, 6) AS tone, round(least(1e0, 5e-1 + CASE WHEN a > 0 OR c > 0 THEN 3e-1 ELSE 0e0 END + least(len / 2e3, 2e-1)), 6) AS conflicts, round(CASE WHEN a + b + c = 0 THEN 1e-1 ELSE least(1e0, 3e-1 + least((a + b + c) / 1e1, 5e-1) + CASE WHEN a > 0 THEN 2e-1 ELSE 0e0 END + CASE WHEN b > 0 THEN 2e-1 ELSE 0e0 END + CASE WHEN c > 0 THEN 1e-1 ELSE 0e0 END) END, 6) AS location FROM k")
def xx5_confidences(spark, sf_dir):
    a, b, c, n = F.col("a"), F.col("b"), F.col("c"), F.col("d") * 300
    return _studies(spark, sf_dir).select("study_id", F.round(analysis.tone_confidence(a, b, n), 6).alias("tone"), F.round(analysis.conflict_confidence(a, c, n), 6).alias("conflicts"), F.round(analysis.location_confidence(a, b, c), 6).alias("location"))


@query(f"WITH s AS ({STUDIES}) SELECT study_id, CASE WHEN b >= 7e-1 * d THEN 'strong' WHEN b >= 4e-1 * d THEN 'moderate' ELSE 'weak' END AS strength FROM s")
def tx25_claim_strength(spark, sf_dir):
    return _studies(spark, sf_dir).select("study_id", analysis.claim_strength(F.col("b"), F.col("d")).alias("strength"))


@query(f"WITH s AS ({STUDIES}), r AS (SELECT study_id, row_number() OVER (ORDER BY a, CASE WHEN b = 0 THEN 0e0 ELSE b * 1e0 END DESC, c DESC, study_id) AS position, a, d, count(*) OVER () AS al FROM s) SELECT study_id, position, a >= 7 OR position > al * 8e-1 OR d / 1e1 < 3e-1 AS high_risk FROM r")
def w10_final_positions(spark, sf_dir):
    s = _studies(spark, sf_dir).select("study_id", F.col("a").alias("quality_rank"), F.when(F.col("b") > 0, F.col("b").cast("double")).alias("llm_score"), F.col("c").alias("quality"), (F.col("d") / 10.0).alias("confidence"))
    return analysis.final_positions(s).select("study_id", "position", "high_risk")


@query(f"WITH s AS ({STUDIES}) SELECT study_id FROM s WHERE a >= 7 OR b // 6 > 0 OR d >= 6 OR {EVIDENCE} IN ('weak', 'insufficient')")
def prj12_high_risk(spark, sf_dir):
    s = _studies(spark, sf_dir).select("study_id", F.col("a").alias("quality_rank"), F.floor(F.col("b") / 6).alias("critical"), F.floor(F.col("d") / 2).alias("major"), _evidence().alias("evidence"))
    return analysis.high_risk(s).select("study_id")


PUBS = "SELECT p_type AS journal_type, CASE WHEN p_size % 4 <> 0 THEN p_size / 4e0 END AS impact_factor, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS open_access, CASE p_partkey % 5 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS peer_reviewed, CAST(p_size % 4 AS BIGINT) AS funding FROM part"


@query(f"WITH p AS ({PUBS}) SELECT journal_type, count(*) AS n, round(sum(coalesce(impact_factor, 0)) / count(*), 6) AS mean_impact, count(*) FILTER (open_access) AS open_access, count(*) FILTER (peer_reviewed) AS peer_reviewed FROM p GROUP BY 1")
def ag11_publication_report(spark, sf_dir):
    return analysis.publication_report(A.select(spark, sf_dir, PUBS, "part")).withColumn("mean_impact", F.round("mean_impact", 6))


@query(f"WITH p AS ({PUBS}), d AS (SELECT 'impact' AS dim, CASE WHEN impact_factor IS NULL THEN NULL WHEN impact_factor < 2 THEN '< 2.0' WHEN impact_factor < 5 THEN '2.0 - 4.9' WHEN impact_factor < 10 THEN '5.0 - 9.9' ELSE '≥ 10.0' END AS value FROM p UNION ALL SELECT 'open', coalesce(CAST(open_access AS VARCHAR), 'unknown') FROM p UNION ALL SELECT 'funding', CASE WHEN funding >= 2 THEN 'full' WHEN funding = 1 THEN 'partial' ELSE 'none' END FROM p) SELECT dim, value, count(*) AS n FROM d GROUP BY 1, 2")
def ag13_disclosure_report(spark, sf_dir):
    p = A.select(spark, sf_dir, PUBS, "part")
    return analysis.distribution(p, impact=analysis.impact_range(F.col("impact_factor")), open=F.coalesce(F.col("open_access").cast("string"), F.lit("unknown")), funding=analysis.transparency(F.col("funding")))


LINKS = "SELECT l_returnflag AS heuristic, l_orderkey AS doc_id, l_partkey % 7 AS asset_id FROM lineitem"
GOLD = "SELECT o_orderkey AS doc_id, o_custkey % 7 AS asset_id FROM orders"


@query(f"WITH l AS (SELECT DISTINCT * FROM ({LINKS}) x), g AS ({GOLD}), h AS (SELECT heuristic, count(*) AS links, count(g.doc_id) AS correct FROM l LEFT JOIN g USING (doc_id, asset_id) GROUP BY 1), m AS (SELECT *, correct / CAST(links AS DOUBLE) AS p, correct / CAST((SELECT count(*) FROM g) AS DOUBLE) AS r FROM h) SELECT heuristic, links, correct, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM m")
def ag4_link_metrics(spark, sf_dir):
    out = analysis.link_metrics(A.select(spark, sf_dir, LINKS, "lineitem"), A.select(spark, sf_dir, GOLD, "orders"))
    return out.select("heuristic", "links", "correct", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query("WITH p AS (SELECT DISTINCT p_name AS name FROM part), t AS (SELECT name, list_sort(list_distinct(string_split(name, ' '))) AS t FROM p) SELECT name, t[1] || '|' || t[2] AS pair FROM t WHERE len(t) = 2")
def er10_token_pairs(spark, sf_dir):
    names = A.tables(spark, sf_dir, "part")["part"].select(F.col("p_name").alias("name")).distinct()
    return names.select("name", F.explode(analysis.token_pairs(T.tokens(F.col("name")))).alias("pair"))


@query(f"WITH v AS ({A.VERSIONS}), p AS (SELECT *, lag(sample_size) OVER w AS ws, lag(endpoint) OVER w AS we, lag(completion) OVER w AS wc, row_number() OVER w AS n FROM v WINDOW w AS (PARTITION BY trial_id ORDER BY captured_at, version_id)), d AS (SELECT version_id, 'sample_size' AS field, CASE WHEN ws IS NULL THEN 'ADDED' WHEN sample_size IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END AS change_type, 'MEDIUM' AS significance FROM p WHERE n > 1 AND sample_size IS DISTINCT FROM ws AND coalesce(abs(sample_size - ws) / nullif(CAST(ws AS DOUBLE), 0) >= 1e-1, true) UNION ALL SELECT version_id, 'endpoint', CASE WHEN we IS NULL THEN 'ADDED' WHEN endpoint IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END, 'HIGH' FROM p WHERE n > 1 AND endpoint IS DISTINCT FROM we UNION ALL SELECT version_id, 'completion', 'MODIFIED', 'LOW' FROM p WHERE n > 1 AND completion <> wc) SELECT * FROM d")
def ch8_typed_changes(spark, sf_dir):
    fields = ("sample_size", "endpoint", "completion")
    pv = versions.with_previous(A.versions(spark, sf_dir), "trial_id", ["captured_at", "version_id"], list(fields)).where("n > 1")
    found = analysis.typed_changes({f: F.col(f"was_{f}") for f in fields}, {f: F.col(f) for f in fields}, {"sample_size": "MEDIUM", "endpoint": "HIGH"}, {"sample_size": 0.1})
    return pv.select("version_id", F.explode(found).alias("c")).select("version_id", "c.*")


@query("WITH i AS (SELECT o_orderkey AS id, o_orderstatus AS sha FROM orders), c AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE o_orderstatus END AS sha FROM orders WHERE o_orderkey % 3 <> 0) SELECT CASE WHEN c.sha IS NULL THEN 'new' WHEN c.sha = i.sha THEN 'unchanged' ELSE 'updated' END AS state, count(*) AS n FROM i LEFT JOIN c USING (id) GROUP BY 1")
def or2_scan_counters(spark, sf_dir):
    o = A.tables(spark, sf_dir, "orders")["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("sha"))
    held = o.where("id % 3 <> 0").withColumn("sha", F.when(F.col("id") % 5 == 0, "x").otherwise(F.col("sha")))
    return analysis.scan_counters(held, o, "id", "sha")


@query("WITH a AS (SELECT o_custkey AS company_id, o_orderpriority || '#' || o_orderkey AS alias, CAST(left(o_orderpriority, 1) AS INT) AS t, o_orderdate AS ts FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY t, ts DESC, alias) AS rn FROM a), l AS (SELECT company_id, array_to_string(list(alias ORDER BY rn), ',') AS aliases FROM r WHERE rn <= 5 GROUP BY 1) SELECT c_custkey AS company_id, c_name AS name, coalesce(aliases, '') AS aliases, CASE WHEN c_custkey % 2 = 0 THEN 'T' || c_custkey ELSE '' END AS tickers FROM customer LEFT JOIN l ON company_id = c_custkey")
def xx18_company_facts(spark, sf_dir):
    t = A.tables(spark, sf_dir, "orders", "customer")
    aliases = t["orders"].select(F.col("o_custkey").alias("company_id"), F.concat("o_orderpriority", F.lit("#"), F.col("o_orderkey").cast("string")).alias("alias"), F.substring("o_orderpriority", 1, 1).cast("int").alias("type_rank"), F.col("o_orderdate").alias("created_at"))
    companies = t["customer"].select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"))
    securities = companies.where("company_id % 2 = 0").select("company_id", F.concat(F.lit("T"), F.col("company_id").cast("string")).alias("ticker"), F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    out = analysis.company_facts(companies, aliases, securities)
    return out.select("company_id", "name", F.array_join("aliases", ",").alias("aliases"), F.array_join("tickers", ",").alias("tickers"))


@query()
def snk10_new_versions(spark, sf_dir):
    v = A.versions(spark, sf_dir).select("trial_id", "version_id", "captured_at", "endpoint", "sample_size")
    payload = ["endpoint", "sample_size"]
    old = v.where("version_id % 2 = 0").withColumn("sha256", F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(payload)))), 256))
    return ops.new_version(old, v.where("version_id % 2 = 1"), "trial_id", payload).select("trial_id", "version_id", "sha256")
