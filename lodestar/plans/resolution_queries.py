"""Queries over similar names, candidates with their halves, nine features and the whole resolution job, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import resolution
from lodestar.plans import adapters as A
from lodestar.plans.entity_queries import ALIASES, COMPANIES, GRAMS, HOSTS, JW, LOOSE, NORM, SPONSORS, TOKS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


# --- similar names ------------------------------------------------------------------------------------

SOUGHT = "SELECT DISTINCT 'new ' || p_name || ' ' || lower(p_type) AS q FROM part"
TEXTS = "SELECT DISTINCT p_name AS text FROM part UNION SELECT DISTINCT lower(p_type) || ' ' || p_brand FROM part UNION SELECT DISTINCT c_name FROM customer"


@query(
    f"""WITH a AS (SELECT q, {GRAMS.format('lower(q)')} AS g FROM ({SOUGHT})), b AS (SELECT text, {GRAMS.format('lower(text)')} AS g FROM ({TEXTS})),
  x AS (SELECT q, len(g) AS n, unnest(g) AS t FROM a), y AS (SELECT text, len(g) AS n, unnest(g) AS t FROM b), k AS (SELECT q, text, count(*) / CAST(x.n + y.n - count(*) AS DOUBLE) AS sim FROM x JOIN y USING (t) GROUP BY q, text, x.n, y.n)
  SELECT q, text, round(sim, 9) AS sim FROM k WHERE sim >= 3e-1"""
)
def er3_similar_texts(spark, sf_dir):
    found = resolution.similar_texts(A.select(spark, sf_dir, SOUGHT, "part"), A.select(spark, sf_dir, TEXTS, "part", "customer"))
    return found.select("q", "text", F.round("sim", 9).alias("sim"))


# --- candidates ---------------------------------------------------------------------------------------

SECURITIES = "SELECT s_suppkey AS company_id, 'T' || CAST(s_suppkey AS VARCHAR(20)) AS ticker, CASE s_suppkey % 3 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'PINK' ELSE 'Nasdaq' END AS exchange FROM supplier WHERE s_suppkey % 4 <> 3 UNION ALL SELECT s_suppkey, 'Z' || CAST(s_suppkey AS VARCHAR(20)), 'XNAS' FROM supplier WHERE s_suppkey % 2 = 0"
RETRIEVED = f"""s AS ({SPONSORS}), c AS ({COMPANIES}), al AS ({ALIASES}), u AS (SELECT sponsor, {NORM.format('sponsor')} AS q FROM s), n AS (SELECT company_id, {NORM.format('name')} AS text FROM c), l AS (SELECT company_id, {NORM.format('alias')} AS text FROM al),
  a AS (SELECT q, {GRAMS.format('q')} AS g FROM (SELECT DISTINCT q FROM u)), b AS (SELECT text, {GRAMS.format('text')} AS g FROM (SELECT text FROM n UNION SELECT text FROM l)),
  x AS (SELECT q, len(g) AS n, unnest(g) AS t FROM a), y AS (SELECT text, len(g) AS n, unnest(g) AS t FROM b), k AS (SELECT q, text, count(*) / CAST(x.n + y.n - count(*) AS DOUBLE) AS sim FROM x JOIN y USING (t) GROUP BY q, text, x.n, y.n HAVING count(*) / CAST(x.n + y.n - count(*) AS DOUBLE) >= 3e-1),
  h AS (SELECT q, company_id, sim FROM k JOIN n USING (text) QUALIFY row_number() OVER (PARTITION BY q ORDER BY sim DESC, company_id) <= 5 UNION ALL SELECT q, company_id, sim FROM k JOIN l USING (text) QUALIFY row_number() OVER (PARTITION BY q ORDER BY sim DESC, company_id, text) <= 5),
  m AS (SELECT q, company_id, max(sim) AS sim FROM h GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY sim DESC, company_id) AS INT) AS rank FROM m),
  d AS (SELECT company_id, array_to_string(list_sort(list(DISTINCT lower(alias))), ',') AS domains FROM al WHERE alias_type = 'domain' GROUP BY 1),
  e AS (SELECT * FROM ({SECURITIES}) QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY CASE WHEN upper(exchange) IN ('NASDAQ', 'XNAS') THEN 1 WHEN upper(exchange) = 'NYSE' THEN 2 ELSE 99 END, ticker) = 1),
  o AS (SELECT sponsor, company_id, sim, rank, name, coalesce(website_domain, '') AS website_domain, coalesce(domains, '') AS domains, ticker FROM u JOIN r USING (q) JOIN c USING (company_id) LEFT JOIN d USING (company_id) LEFT JOIN e USING (company_id) WHERE rank <= 10)"""


def inputs(spark, sf_dir):
    return A.select(spark, sf_dir, COMPANIES, "supplier"), A.select(spark, sf_dir, ALIASES, "supplier"), A.select(spark, sf_dir, SECURITIES, "supplier")


@query(f"WITH {RETRIEVED} SELECT sponsor, company_id, round(sim, 9) AS sim, rank, website_domain, domains, ticker FROM o")
def er3_retrieval(spark, sf_dir):
    found = resolution.retrieve(A.select(spark, sf_dir, SPONSORS, "customer"), *inputs(spark, sf_dir), k=10)
    return found.select("sponsor", "company_id", F.round("sim", 9).alias("sim"), "rank", "website_domain", F.array_join("domains", ",").alias("domains"), "ticker")


# --- features -----------------------------------------------------------------------------------------

#: Hosts and tickers are spelled from the row's numbers, so what must be found is known without a search.
SPELLED = """SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'Bio site' || CAST(c_custkey % 5 AS VARCHAR(9)) || '.org labs' WHEN 1 THEN 'University TK' || CAST(c_custkey % 4 AS VARCHAR(9)) || ' group' ELSE 'Plain name' END AS sponsor, 'Acme ' || c_mktsegment AS name,
  CASE WHEN c_custkey % 2 = 0 THEN 'SITE' || CAST(c_custkey % 7 AS VARCHAR(9)) || '.org' ELSE '' END AS website_domain, CASE WHEN c_custkey % 11 <> 0 THEN 'tk' || CAST(c_custkey % 6 AS VARCHAR(9)) END AS ticker,
  CASE WHEN c_custkey % 4 = 1 THEN 'site' || CAST(c_custkey % 5 AS VARCHAR(9)) || '.org' END AS alias_host, CASE WHEN c_custkey % 6 = 5 THEN 'Site' || CAST(c_custkey % 7 AS VARCHAR(9)) || '.org' WHEN c_custkey % 6 = 4 THEN 'site' || CAST(c_custkey % 7 AS VARCHAR(9)) || '.org' END AS context_host,
  CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 9 = 1 END AS drug_code_hit FROM customer"""


@query(
    f"""WITH p AS ({SPELLED}), h AS (SELECT *, list_filter([nullif(lower(website_domain), ''), alias_host], lambda x: x IS NOT NULL) AS hosts, list_filter([CASE id % 3 WHEN 0 THEN 'site' || CAST(id % 5 AS VARCHAR) || '.org' END, lower(context_host)], lambda x: x IS NOT NULL) AS known FROM p)
  SELECT id, CASE WHEN list_has_any(hosts, known) THEN 1e0 ELSE 0e0 END AS domain_root_match, CASE WHEN id % 3 = 1 AND id % 11 <> 0 AND id % 4 = id % 6 THEN 1e0 ELSE 0e0 END AS ticker_string_hit, CASE WHEN id % 3 = 1 THEN 1e0 ELSE 0e0 END AS academic_keyword_penalty,
  CASE WHEN id % 9 = 1 THEN 1e0 ELSE 0e0 END AS drug_code_hit, CASE WHEN context_host IS NOT NULL AND list_contains(hosts, context_host) THEN 1e0 ELSE 0e0 END AS extra_domain_hit, round({JW.format(NORM.format('sponsor'), NORM.format('name'))}, 9) AS jw_primary FROM h"""
)
def er5_nine_features(spark, sf_dir):
    pairs = A.select(spark, sf_dir, SPELLED, "customer")
    hosts = lambda c: F.array_compact(F.array(F.col(c)))
    found = resolution.nine_features(pairs.withColumn("domains", hosts("alias_host")).withColumn("context_domains", hosts("context_host")))
    return found.select("id", "domain_root_match", "ticker_string_hit", "academic_keyword_penalty", "drug_code_hit", "extra_domain_hit", F.round("jw_primary", 9).alias("jw_primary"))


# --- the whole job --------------------------------------------------------------------------------------

_TEXT = SPONSORS.removeprefix("SELECT DISTINCT ").rsplit(" AS sponsor FROM ", 1)[0]
TRIALS = f"SELECT 'N' || CAST(c_custkey AS VARCHAR(20)) AS nct_id, CASE WHEN c_custkey % 13 <> 0 THEN {_TEXT} END AS sponsor_text, CASE WHEN c_custkey % 10 = 0 THEN 5 WHEN c_custkey % 10 = 1 THEN 0 END AS sponsor_company_id FROM customer"
RULES = "SELECT 1 AS rule_id, 'university of auto' AS pattern, 10 AS company_id, 10 AS priority UNION ALL SELECT 2, 'company ltd', 20, 3"
IGNORED = "SELECT '^university of house' AS pattern UNION ALL SELECT 'site1[0-4]'"
_OPEN = f"t AS ({TRIALS}), w AS (SELECT nct_id, sponsor_text AS sponsor FROM t WHERE sponsor_text IS NOT NULL AND coalesce(sponsor_company_id, 0) = 0 AND NOT regexp_matches(sponsor_text, '(?i)^university of house') AND NOT regexp_matches(sponsor_text, '(?i)site1[0-4]'))"
_KEYS = f"""z AS ({HOSTS}), ky AS (SELECT sponsor, 1 AS rank, company_id FROM s JOIN al ON alias_type <> 'domain' AND {NORM.format('sponsor')} = {NORM.format('alias')} UNION SELECT sponsor, 2, company_id FROM s JOIN al ON alias_type <> 'domain' AND {LOOSE.format('sponsor')} = {LOOSE.format('alias')} UNION SELECT sponsor, 3, company_id FROM s JOIN c ON {NORM.format('sponsor')} = {NORM.format('name')} UNION SELECT sponsor, 4, company_id FROM s JOIN c ON {LOOSE.format('sponsor')} = {LOOSE.format('name')} UNION SELECT sponsor, 5, company_id FROM z JOIN al ON alias_type = 'domain' AND host = lower(alias) UNION SELECT sponsor, 6, company_id FROM z JOIN c ON host = website_domain),
  uq AS (SELECT sponsor, rank, min(company_id) AS company_id FROM ky GROUP BY 1, 2 HAVING count(DISTINCT company_id) = 1), ex AS (SELECT sponsor, arg_min(company_id, rank) AS company_id, list_extract(['alias_strict', 'alias_loose', 'name_strict', 'name_loose', 'alias_domain', 'website'], min(rank)) AS step FROM uq GROUP BY 1),
  ru AS (SELECT sponsor, CASE WHEN regexp_matches({NORM.format('sponsor')}, 'company ltd') THEN 20 ELSE 10 END AS company_id, 'rule' AS step FROM s WHERE sponsor NOT IN (SELECT sponsor FROM ex) AND regexp_matches({NORM.format('sponsor')}, 'company ltd|university of auto')), su AS (SELECT * FROM ex UNION ALL SELECT * FROM ru)"""
_SCORED = f"g AS (SELECT sponsor, company_id, {JW.format(NORM.format('sponsor'), NORM.format('name'))} AS jw, {TOKS.format(NORM.format('sponsor'))} AS tx, {TOKS.format(NORM.format('name'))} AS ty FROM o), p AS (SELECT sponsor, company_id, 1 / (1 + exp(-(-3e0 + 4e0 * jw + 1e0 * coalesce(2e0 * len(list_intersect(tx, ty)) / nullif(len(tx) + len(ty), 0), 0)))) AS p FROM g)"


@query(
    f"""WITH {RETRIEVED}, {_OPEN}, {_KEYS}, {_SCORED}, v AS (SELECT nct_id, w.sponsor, company_id, p, row_number() OVER (PARTITION BY nct_id ORDER BY p DESC, company_id) AS rn, p - lead(p, 1, 0e0) OVER (PARTITION BY nct_id ORDER BY p DESC, company_id) AS margin FROM w JOIN p USING (sponsor) WHERE w.sponsor NOT IN (SELECT sponsor FROM su)),
  q2 AS (SELECT *, CASE WHEN p >= 85e-2 AND margin >= 1e-2 THEN 'accept' WHEN p >= 6e-1 THEN 'review' ELSE 'reject' END AS mode FROM v WHERE rn = 1)
  SELECT nct_id, sponsor, company_id, 'accept' AS mode, 'det:' || step AS method, 1e0 AS p FROM w JOIN su USING (sponsor) UNION ALL SELECT nct_id, sponsor, CASE WHEN mode <> 'reject' THEN company_id END, mode, 'prob', round(p, 9) FROM q2"""
)
def er9_decisions(spark, sf_dir):
    trials = A.select(spark, sf_dir, TRIALS, "customer").withColumn("context_domains", F.lit(None).cast("array<string>")).withColumn("drug_code_hit", F.lit(None).cast("boolean"))
    out = resolution.resolve_trials(trials, *inputs(spark, sf_dir), spark.sql(RULES), spark.sql(IGNORED), F.lit("run"), weights={"jw_primary": 4.0, "token_set_ratio": 1.0}, intercept=-3.0, tau=0.85, low=0.6, margin=0.01, k=10)
    return out["decisions"].select("nct_id", "sponsor", "company_id", "mode", "method", F.round("p", 9).alias("p"))
