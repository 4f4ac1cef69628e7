"""Queries over resolution, extraction, quality, tables and monitoring, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import dates
from lodestar.functions import text as T
from lodestar.functions.udfs import html_text, sequence_ratio
from lodestar.operators import extract, monitor, quality, resolve
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


# --- resolution -------------------------------------------------------------------------------------

COMPANIES = "SELECT s_suppkey AS company_id, 'Acme ' || s_name || CASE WHEN s_suppkey % 3 = 0 THEN ' Inc.' WHEN s_suppkey % 3 = 1 THEN ' and Company, Ltd' ELSE '' END AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'site' || CAST(s_suppkey AS VARCHAR(20)) || '.example.com' END AS website_domain FROM supplier"
SPONSORS = "SELECT DISTINCT CASE WHEN c_custkey % 4 = 0 THEN 'ACME Supplier#' || lpad(CAST(c_custkey % 150 AS VARCHAR(20)), 9, '0') || ' inc' WHEN c_custkey % 4 = 1 THEN 'Acme supplier ' || lpad(CAST(c_custkey % 150 AS VARCHAR(20)), 9, '0') || ' & company ltd.' WHEN c_custkey % 4 = 2 THEN 'see https://www.site' || CAST(c_custkey % 150 AS VARCHAR(20)) || '.example.com/x' ELSE 'University of ' || c_mktsegment END AS sponsor FROM customer"
NORM = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9_-]+', ' ', 'g'), ' +', ' ', 'g'))"
LOOSE = "trim(regexp_replace(regexp_replace(" + NORM + ", '\\band\\b', ' ', 'g'), ' +', ' ', 'g'))"


def _companies(spark, sf_dir) -> DataFrame:
    return A.select(spark, sf_dir, COMPANIES, "supplier")


def _sponsors(spark, sf_dir) -> DataFrame:
    return A.select(spark, sf_dir, SPONSORS, "customer")


@query(f"WITH s AS ({SPONSORS}) SELECT sponsor, {NORM.format('sponsor')} AS norm, {LOOSE.format('sponsor')} AS loose, regexp_matches(sponsor, 'University') AS academic FROM s")
def er1_name_norms(spark, sf_dir):
    s = F.col("sponsor")
    return _sponsors(spark, sf_dir).select("sponsor", T.norm_name(s).alias("norm"), T.norm_loose(s).alias("loose"), T.is_academic(s).alias("academic"))


ALIASES = "SELECT s_suppkey + 1 AS company_id, 'ACME Supplier#' || lpad(CAST(s_suppkey AS VARCHAR(20)), 9, '0') || ' inc' AS alias, 'legal' AS alias_type FROM supplier WHERE s_suppkey % 3 = 1 UNION ALL SELECT s_suppkey, 'Acme supplier ' || lpad(CAST(s_suppkey AS VARCHAR(20)), 9, '0') || ' and company ltd', 'aka' FROM supplier WHERE s_suppkey % 5 = 1 UNION ALL SELECT s_suppkey, 'SITE' || CAST(s_suppkey AS VARCHAR(20)) || '.example.com', 'domain' FROM supplier WHERE s_suppkey % 4 = 2 UNION ALL SELECT s_suppkey % 3, 'University of MACHINERY', 'aka' FROM supplier UNION ALL SELECT 7, 'University of BUILDING', 'aka' FROM supplier"
HOSTS = "SELECT sponsor, regexp_extract(sponsor, 'www\\.(site[0-9]+\\.example\\.com)', 1) AS host FROM s"


@query(f"WITH s AS ({SPONSORS}), c AS ({COMPANIES}), al AS ({ALIASES}), x AS ({HOSTS}), k AS (SELECT sponsor, 1 AS rank, company_id FROM s JOIN al ON alias_type <> 'domain' AND {NORM.format('sponsor')} = {NORM.format('alias')} UNION SELECT sponsor, 2, company_id FROM s JOIN al ON alias_type <> 'domain' AND {LOOSE.format('sponsor')} = {LOOSE.format('alias')} UNION SELECT sponsor, 3, company_id FROM s JOIN c ON {NORM.format('sponsor')} = {NORM.format('name')} UNION SELECT sponsor, 4, company_id FROM s JOIN c ON {LOOSE.format('sponsor')} = {LOOSE.format('name')} UNION SELECT sponsor, 5, company_id FROM x JOIN al ON alias_type = 'domain' AND host = lower(alias) UNION SELECT sponsor, 6, company_id FROM x JOIN c ON host = website_domain), u AS (SELECT sponsor, rank, min(company_id) AS company_id FROM k GROUP BY 1, 2 HAVING count(DISTINCT company_id) = 1) SELECT sponsor, arg_min(company_id, rank) AS company_id, list_extract(['alias_strict', 'alias_loose', 'name_strict', 'name_loose', 'alias_domain', 'website'], min(rank)) AS step FROM u GROUP BY 1")
def er2_deterministic(spark, sf_dir):
    return resolve.deterministic(_sponsors(spark, sf_dir), _companies(spark, sf_dir), A.select(spark, sf_dir, ALIASES, "supplier"))


@query(f"WITH s AS ({SPONSORS}), r AS (SELECT * FROM (VALUES (1, 'supplier.0000000[0-4]', 10, 5), (2, 'company', 20, 3), (3, 'university', 30, 9)) v(rule_id, pattern, company_id, priority)), m AS (SELECT sponsor, r.* FROM s JOIN r ON regexp_matches(sponsor, '(?i)' || pattern)) SELECT sponsor, arg_min(company_id, priority) AS company_id, arg_min(rule_id, priority) AS rule_id FROM m GROUP BY 1")
def er2b_regex_rules(spark, sf_dir):
    rules = spark.createDataFrame([(1, "supplier.0000000[0-4]", 10, 5), (2, "company", 20, 3), (3, "university", 30, 9)], "rule_id int, pattern string, company_id int, priority int")
    return resolve.by_rules(_sponsors(spark, sf_dir), rules)


@query(f"WITH s AS ({SPONSORS}) SELECT sponsor FROM s WHERE NOT regexp_matches(sponsor, '(?i)^university') AND NOT regexp_matches(sponsor, '(?i)site1')")
def prj8_ignore_list(spark, sf_dir):
    return resolve.not_ignored(_sponsors(spark, sf_dir), spark.createDataFrame([("^university",), ("site1",)], "pattern string"))


GRAMS = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array({0}, '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
PARTS = "SELECT DISTINCT p_name AS name FROM part"


CANDIDATES = f"p AS ({PARTS}), n AS (SELECT name, {GRAMS.format('name')} AS g FROM p), a AS (SELECT name AS sponsor, unnest(g) AS t, len(g) AS na FROM n), b AS (SELECT name, unnest(g) AS t, len(g) AS nb FROM n), k AS (SELECT sponsor, name, na, nb, count(*) AS c FROM a JOIN b USING (t) GROUP BY ALL), m AS (SELECT sponsor, name, c / CAST(na + nb - c AS DOUBLE) AS sim FROM k WHERE c / CAST(na + nb - c AS DOUBLE) >= 3e-1), o AS (SELECT *, row_number() OVER (PARTITION BY sponsor ORDER BY sim DESC, name) AS rank FROM m)"


def _candidates(spark, sf_dir, k: int) -> DataFrame:
    names = A.select(spark, sf_dir, PARTS, "part")
    return resolve.candidates(names.withColumnRenamed("name", "sponsor"), names.withColumn("company_id", F.col("name")), k=k)


@query(f"WITH {CANDIDATES} SELECT sponsor, name AS company_id, round(sim, 6) AS sim, rank FROM o WHERE rank <= 5")
def er3_trigram_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir, 5).select("sponsor", "company_id", F.round("sim", 6).alias("sim"), "rank")


JW = "(jaro_similarity({0}, {1}) + 1e-1 * (1 - jaro_similarity({0}, {1})) * CASE WHEN substr({0}, 1, 1) <> substr({1}, 1, 1) THEN 0 WHEN substr({0}, 2, 1) <> substr({1}, 2, 1) THEN 1 WHEN substr({0}, 3, 1) <> substr({1}, 3, 1) THEN 2 WHEN substr({0}, 4, 1) <> substr({1}, 4, 1) THEN 3 ELSE 4 END)"
TOKS = "list_distinct(list_filter(regexp_split_to_array({0}, '[^a-z0-9-]+'), lambda w: w <> ''))"
PAIRS = f"WITH {CANDIDATES}, f AS (SELECT sponsor, name, {JW.format('sponsor', 'name')} AS jw, {TOKS.format('sponsor')} AS x, {TOKS.format('name')} AS y FROM o WHERE rank <= 10), g AS (SELECT sponsor, name, jw, 2e0 * len(list_intersect(x, y)) / (len(x) + len(y)) AS dice FROM f), h AS (SELECT *, 1 / (1 + exp(-(-5e0 + 28e-1 * jw + 24e-1 * dice))) AS p FROM g)"


def _features(spark, sf_dir) -> DataFrame:
    pairs = _candidates(spark, sf_dir, 10).select("sponsor", "name", F.lit(None).cast("string").alias("website_domain"), F.lit(None).cast("string").alias("ticker"))
    weights = {"jw_primary": 2.8, "token_set_ratio": 2.4}
    return resolve.features(pairs).withColumn("p", resolve.logistic_score(weights))


@query(f"{PAIRS} SELECT sponsor, name, round(jw, 6) AS jw_primary, round(dice, 6) AS token_set_ratio, round(p, 6) AS p FROM h")
def er5_pair_features(spark, sf_dir):
    return _features(spark, sf_dir).select("sponsor", "name", *(F.round(c, 6).alias(c) for c in ("jw_primary", "token_set_ratio", "p")))


@query(f"{PAIRS}, i AS (SELECT sponsor, name, round(p, 6) AS p FROM h WHERE sponsor <> name), r AS (SELECT *, row_number() OVER w AS rn, p - lead(p, 1, 0e0) OVER w AS margin FROM i WINDOW w AS (PARTITION BY sponsor ORDER BY p DESC, name)) SELECT sponsor, CASE WHEN p >= 3e-1 AND margin >= 1e-2 THEN 'accept' WHEN p >= 1e-1 THEN 'review' ELSE 'reject' END AS mode, CASE WHEN p >= 1e-1 THEN name END AS company_id, p, round(margin, 6) AS margin FROM r WHERE rn = 1")
def er7_decision(spark, sf_dir):
    scored = _features(spark, sf_dir).where("sponsor <> name").select("sponsor", F.col("name").alias("company_id"), F.round("p", 6).alias("p"))
    return resolve.decide(scored, 0.3, 0.1, 0.01).withColumn("margin", F.round("margin", 6))


EDGES = "SELECT 'R' || CAST(r_regionkey AS VARCHAR(20)) AS parent, 'N' || CAST(n_nationkey AS VARCHAR(20)) AS child FROM region JOIN nation ON n_regionkey = r_regionkey UNION ALL SELECT 'N' || CAST(c_nationkey AS VARCHAR(20)), 'C' || CAST(c_custkey AS VARCHAR(20)) FROM customer UNION ALL SELECT 'K' || CAST(p_partkey - 1 AS VARCHAR(20)), 'K' || CAST(p_partkey AS VARCHAR(20)) FROM part WHERE p_partkey >= 1"


@query("SELECT 'N' || n_nationkey AS child, 'R' || n_regionkey AS top, 1 AS depth FROM nation UNION ALL SELECT 'C' || c_custkey, 'R' || n_regionkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'K' || p_partkey, 'K0', CAST(p_partkey AS INT) FROM part WHERE p_partkey >= 1")
def er17_roll_up(spark, sf_dir):
    return resolve.roll_up(A.select(spark, sf_dir, EDGES, "region", "nation", "customer", "part"))


@query("WITH s AS (SELECT p_brand AS company_id, CASE p_size % 6 WHEN 0 THEN 'nasdaq' WHEN 1 THEN 'XNYS' WHEN 2 THEN 'OTCQB' WHEN 3 THEN 'NYSE Arca' WHEN 4 THEN 'AMEX' ELSE 'LSE' END AS exchange, p_type || CAST(p_partkey AS VARCHAR) AS ticker FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY CASE upper(exchange) WHEN 'NASDAQ' THEN 1 WHEN 'XNYS' THEN 2 WHEN 'AMEX' THEN 3 WHEN 'NYSE ARCA' THEN 4 WHEN 'OTCQB' THEN 6 ELSE 99 END, ticker) AS rn FROM s) SELECT company_id, exchange, ticker FROM r WHERE rn = 1")
def w1_best_security(spark, sf_dir):
    s = A.tables(spark, sf_dir, "part")["part"].select(F.col("p_brand").alias("company_id"), F.when(F.col("p_size") % 6 == 0, "nasdaq").when(F.col("p_size") % 6 == 1, "XNYS").when(F.col("p_size") % 6 == 2, "OTCQB").when(F.col("p_size") % 6 == 3, "NYSE Arca").when(F.col("p_size") % 6 == 4, "AMEX").otherwise("LSE").alias("exchange"), F.concat("p_type", F.col("p_partkey").cast("string")).alias("ticker"))
    return resolve.best_security(s)


SCORED = "SELECT l_suppkey AS sponsor, l_partkey AS company_id, max(l_discount * 10) AS p FROM lineitem GROUP BY 1, 2"
ACCEPT = "SELECT s_suppkey AS sponsor, min(l_partkey) AS company_id FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE s_suppkey % 2 = 0 GROUP BY 1"


@query(f"WITH s AS ({SCORED}), a AS ({ACCEPT}), g AS (SELECT sponsor, company_id, 1 AS label FROM s JOIN a USING (sponsor, company_id)), b AS (SELECT s.sponsor, s.company_id, row_number() OVER (PARTITION BY s.sponsor ORDER BY s.p DESC, s.company_id) AS rn FROM s JOIN a ON a.sponsor = s.sponsor AND a.company_id <> s.company_id) SELECT sponsor, company_id, label FROM g UNION ALL SELECT sponsor, company_id, 0 FROM b WHERE rn <= 20")
def er13_training_rows(spark, sf_dir):
    scored, accepted = A.select(spark, sf_dir, SCORED, "lineitem"), A.select(spark, sf_dir, ACCEPT, "supplier", "lineitem")
    return resolve.training_rows(scored, accepted).select("sponsor", "company_id", "label")


@query(f"WITH s AS ({SCORED}), q AS (SELECT DISTINCT sponsor FROM s WHERE sponsor % 3 = 0 AND sponsor % 2 = 1), r AS (SELECT sponsor, company_id, row_number() OVER (PARTITION BY sponsor ORDER BY p DESC, company_id) AS rn FROM s JOIN q USING (sponsor)) SELECT sponsor, array_to_string(list(company_id ORDER BY rn), ',') AS candidates FROM r WHERE rn <= 5 GROUP BY 1")
def er16_review_queue(spark, sf_dir):
    scored = A.select(spark, sf_dir, SCORED, "lineitem")
    decided = scored.select("sponsor").distinct().withColumn("mode", F.when(F.col("sponsor") % 3 == 0, "review").otherwise("reject"))
    pending = scored.select("sponsor").distinct().where("sponsor % 2 = 0")
    out = resolve.review_queue(scored, decided, pending)
    return out.select("sponsor", F.array_join(F.transform("candidates", lambda c: c["company_id"].cast("string")), ",").alias("candidates"))


# --- text -------------------------------------------------------------------------------------------


NOTES = "SELECT p_partkey AS doc_id, 'Trial of ' || upper(substr(p_name, 1, 2)) || '-' || CAST(p_partkey AS VARCHAR(20)) || ' with ' || upper(substr(p_name, 1, 3)) || CAST(p_partkey * 7 AS VARCHAR(20)) || 'X, BMS-' || upper(substr(p_type, 1, 2)) || '-' || CAST(p_partkey + 10 AS VARCHAR(20)) || ' (nct' || CAST(p_partkey AS VARCHAR(20)) || ', NCT0' || CAST(p_size AS VARCHAR(20)) || ') and A-123X or ' || p_name || '.' AS text FROM part"
EACH_CODE = ", ".join(f"regexp_extract_all(text, '{p}')" for p in extract.CODE_PATTERNS)


def _notes(spark, sf_dir) -> DataFrame:
    return A.select(spark, sf_dir, NOTES, "part")


@query(f"WITH d AS ({NOTES}) SELECT doc_id, unnest(list_distinct(flatten([{EACH_CODE}]))) AS value_norm FROM d")
def tx1_code_entities(spark, sf_dir):
    return extract.codes(_notes(spark, sf_dir), "doc_id", "text").select("doc_id", "value_norm").distinct()


@query(f"WITH d AS ({NOTES}), e AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)\\bNCT[0-9]+\\b')) AS v FROM d) SELECT doc_id, upper(v) AS value_norm, count(*) AS n FROM e GROUP BY 1, 2")
def tx3_registry_ids(spark, sf_dir):
    return extract.registry_ids(_notes(spark, sf_dir), "doc_id", "text").groupBy("doc_id", "value_norm").agg(F.count("*").alias("n"))


ENTS = "SELECT l_orderkey AS doc_id, CAST(l_linenumber % 2 AS INT) AS page_no, 'K' || CAST(l_partkey % 50 AS VARCHAR(20)) AS value_norm, CAST(floor(l_extendedprice) AS BIGINT) % 2000 AS char_start, CAST(floor(l_extendedprice) AS BIGINT) % 2000 + 6 AS char_end, l_returnflag AS ent_type, l_discount AS confidence FROM lineitem"


def _ents(spark, sf_dir) -> DataFrame:
    return A.select(spark, sf_dir, ENTS, "lineitem")


@query(f"WITH e AS ({ENTS}) SELECT a.doc_id, a.page_no, a.value_norm AS left_value, b.value_norm AS right_value, a.char_start AS left_start, b.char_start AS right_start, CAST(abs(a.char_start - b.char_start) AS DOUBLE) AS distance FROM e a JOIN e b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND a.ent_type = 'A' AND b.ent_type = 'N' AND abs(a.char_start - b.char_start) <= 250")
def tx6_proximity_pairs(spark, sf_dir):
    e = _ents(spark, sf_dir)
    return extract.near_pairs(e.where("ent_type = 'A'"), e.where("ent_type = 'N'"))


@query(f"WITH e AS (SELECT DISTINCT * FROM ({ENTS}) x), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, value_norm ORDER BY confidence DESC, page_no, char_start, char_end) AS n FROM e) SELECT doc_id, value_norm, page_no, char_start FROM r WHERE n = 1")
def tx4_entity_dedupe(spark, sf_dir):
    return extract.dedupe(_ents(spark, sf_dir), "content").select("doc_id", "value_norm", "page_no", "char_start")


@query(f"WITH e AS ({ENTS}), al AS (SELECT 'K' || CAST(p_partkey % 60 AS VARCHAR) AS alias_norm, CASE WHEN p_partkey % 3 = 0 THEN p_size % 40 ELSE p_partkey % 60 END AS asset_id FROM part), o AS (SELECT alias_norm, min(asset_id) AS asset_id FROM al GROUP BY 1 HAVING count(DISTINCT asset_id) = 1) SELECT DISTINCT doc_id, value_norm, asset_id FROM e JOIN o ON alias_norm = value_norm")
def tx9_unique_codes(spark, sf_dir):
    alias = A.tables(spark, sf_dir, "part")["part"].select(F.concat(F.lit("K"), (F.col("p_partkey") % 60).cast("string")).alias("alias_norm"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") % 40).otherwise(F.col("p_partkey") % 60).alias("asset_id"))
    return extract.unique_codes(_ents(spark, sf_dir), alias).select("doc_id", "value_norm", "asset_id")


LINKS = "SELECT l_orderkey AS doc_id, l_partkey % 7 AS asset_id, max(l_discount * 10) AS confidence FROM lineitem GROUP BY 1, 2"


@query(f"WITH l AS ({LINKS}), n AS (SELECT doc_id, count(DISTINCT asset_id) AS assets FROM l GROUP BY 1) SELECT doc_id, asset_id, assets > 1 AND doc_id % 3 <> 0 AS conflict, CASE WHEN assets > 1 AND doc_id % 3 <> 0 THEN greatest(0e0, round(confidence - 2e-1, 6)) ELSE confidence END AS confidence FROM l JOIN n USING (doc_id)")
def tx11_conflict_downgrade(spark, sf_dir):
    links = A.select(spark, sf_dir, LINKS, "lineitem")
    combo = links.select("doc_id").distinct().withColumn("is_combination", F.col("doc_id") % 3 == 0)
    return extract.downgrade_conflicts(links, combo).select("doc_id", "asset_id", "conflict", "confidence")


@query("WITH a AS (SELECT d.source AS heuristic, quality = 1 AS label FROM documents d LEFT JOIN labels USING (doc_id)) , p AS (SELECT heuristic, count(*) AS links, count(label) AS reviewed, count(*) FILTER (label) AS correct FROM a GROUP BY 1), q AS (SELECT *, round(correct / nullif(CAST(reviewed AS DOUBLE), 0), 4) AS precision FROM p) SELECT *, coalesce(precision >= 9e-1 AND reviewed >= 10, false) AS promote FROM q")
def tx12_link_precision(spark, sf_dir):
    t = A.tables(spark, sf_dir, "documents", "labels")
    audit = t["documents"].select("doc_id", F.col("source").alias("heuristic")).join(t["labels"], "doc_id", "left").select("heuristic", (F.col("quality") == 1).alias("label"))
    return extract.may_promote(extract.link_precision(audit), 0.9, 10)


WORDING = "SELECT c_custkey AS doc_id, CASE c_custkey % 4 WHEN 0 THEN 'This may suggest Limited, preliminary results; it appears unclear.' WHEN 1 THEN 'Clearly robust and highly significant: the data demonstrate a strong effect.' WHEN 2 THEN 'It could confirm an initial finding' ELSE c_mktsegment END || CASE c_custkey % 3 WHEN 0 THEN ' Further study might verify an evident hypothesis.' ELSE '' END AS text FROM customer"
HITS = {k: " + ".join(f"len(regexp_extract_all(text, '(?i){p}'))" for p in v) for k, v in (("cautious", extract.CAUTIOUS), ("definite", extract.DEFINITE))}


@query(f"WITH d AS ({WORDING}), t AS (SELECT doc_id, {HITS['cautious']} AS cautious, {HITS['definite']} AS definite FROM d) SELECT *, CASE WHEN definite > 2 * cautious THEN 'definitive' WHEN cautious > 2 * definite THEN 'cautious' ELSE 'neutral' END AS tone FROM t")
def tx22_wording_counts(spark, sf_dir):
    t = A.select(spark, sf_dir, WORDING, "customer").select("doc_id", extract.tone(F.col("text")).alias("t"))
    return t.select("doc_id", F.col("t.cautious").cast("long").alias("cautious"), F.col("t.definite").cast("long").alias("definite"), "t.tone")


@query("WITH c AS (SELECT conv_id, turn, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) AS p FROM conversations), u AS (SELECT conv_id * 100 + turn AS doc_id, unnest(p) AS chunk, unnest(range(len(p))) AS para_no FROM c), s AS (SELECT *, coalesce(sum(len(chunk) + 2) OVER (PARTITION BY doc_id ORDER BY para_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM u) SELECT doc_id, CAST(para_no AS INT) AS para_no, CAST(start AS INT) AS start, chunk FROM s WHERE trim(chunk) <> ''")
def tx21_chunks(spark, sf_dir):
    c = A.tables(spark, sf_dir, "conversations")["conversations"]
    docs = c.select((F.col("conv_id") * 100 + F.col("turn")).alias("doc_id"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return extract.chunks(docs, "doc_id", "text")


NAMES = "SELECT DISTINCT split_part(p_name, ' ', 1) AS alias_norm FROM part UNION SELECT DISTINCT p_name FROM part WHERE p_size % 2 = 0"


@query(f"WITH d AS ({NOTES}), w AS (SELECT doc_id, list_distinct(list_concat(regexp_extract_all(lower(text), '[a-z][a-z0-9-]{{2,}}'), list_transform(regexp_extract_all(text, '\\b[A-Za-z][A-Za-z0-9-]+ [A-Za-z][A-Za-z0-9-]+\\b'), lambda x: lower(x)))) AS w FROM d), u AS (SELECT doc_id, unnest(w) AS alias_norm FROM w) SELECT doc_id, alias_norm FROM u JOIN ({NAMES}) n USING (alias_norm)")
def tx15_dictionary_hits(spark, sf_dir):
    words = A.select(spark, sf_dir, NAMES, "part").withColumn("asset_id", F.lit(1))
    return extract.dictionary_hits(_notes(spark, sf_dir), "doc_id", "text", words).select("doc_id", "alias_norm")


@query()
def tx17_html_text(spark, sf_dir):
    pages = A.tables(spark, sf_dir, "pages")["pages"]
    return pages.select("page_id", html_text(F.col("html")).alias("text"))


@query()
def ch6_sequence_ratio(spark, sf_dir):
    c = A.tables(spark, sf_dir, "conversations")["conversations"]
    w = Window.partitionBy("conv_id").orderBy("turn")
    return c.withColumn("was", F.lag("text").over(w)).where("was is not null").select("conv_id", "turn", F.round(sequence_ratio("was", "text"), 6).alias("ratio"))


@query("WITH c AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'topline on Nov 3, 2025' WHEN 1 THEN 'expected Q' || CAST(1 + c_custkey % 4 AS VARCHAR) || ' 2025' WHEN 2 THEN 'in H' || CAST(1 + c_custkey % 2 AS VARCHAR) || ' 2026' WHEN 3 THEN 'results at ESMO 2025' ELSE 'no date' END AS t FROM customer) SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN DATE '2025-11-02' WHEN 1 THEN make_date(2025, CAST(1 + 3 * (c_custkey % 4) AS INT), 1) WHEN 2 THEN make_date(2026, CAST(1 + 6 * (c_custkey % 2) AS INT), 1) WHEN 3 THEN DATE '2025-01-01' END AS window_start, CASE c_custkey % 5 WHEN 0 THEN DATE '2025-11-05' WHEN 1 THEN last_day(make_date(2025, CAST(3 + 3 * (c_custkey % 4) AS INT), 1)) WHEN 2 THEN last_day(make_date(2026, CAST(6 + 6 * (c_custkey % 2) AS INT), 1)) WHEN 3 THEN DATE '2025-12-31' END AS window_end FROM c")
def ct1_date_hints(spark, sf_dir):
    k = F.col("c_custkey")
    t = F.when(k % 5 == 0, "topline on Nov 3, 2025").when(k % 5 == 1, F.concat(F.lit("expected Q"), (1 + k % 4).cast("string"), F.lit(" 2025"))).when(k % 5 == 2, F.concat(F.lit("in H"), (1 + k % 2).cast("string"), F.lit(" 2026"))).when(k % 5 == 3, "results at ESMO 2025").otherwise("no date")
    w = A.tables(spark, sf_dir, "customer")["customer"].select("c_custkey", t.alias("t")).select("c_custkey", dates.text_window(F.col("t")).alias("w"))
    return w.select("c_custkey", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


# --- quality ----------------------------------------------------------------------------------------

TRIAL_ROWS = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'NCT' || CAST(o_orderkey AS VARCHAR(20)) END AS nct_id, o_orderpriority AS brief_title, o_orderstatus AS sponsor_name, CASE o_orderkey % 6 WHEN 0 THEN 'PHASE2' WHEN 1 THEN 'PHASE3' WHEN 2 THEN 'PHASE9' WHEN 3 THEN NULL ELSE 'PHASE2_PHASE3' END AS phase, CAST(o_orderdate AS DATE) AS study_start, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS primary_completion, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) - 1 ELSE CAST(o_orderdate AS DATE) + 60 END AS study_completion, CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'abc' WHEN 2 THEN NULL ELSE '120' END AS enrollment_count FROM orders"
DQ = f"""WITH t AS ({TRIAL_ROWS}), r AS (SELECT id, unnest([
 {{'rule_id': 'trial_required_fields', 'severity': 'critical', 'status': CASE WHEN nct_id = '' OR phase IS NULL THEN 'FAIL' ELSE 'PASS' END}},
 {{'rule_id': 'trial_phase_valid', 'severity': 'high', 'status': CASE WHEN phase IS NULL THEN 'WARNING' WHEN phase IN ('PHASE1', 'PHASE2', 'PHASE3', 'PHASE4', 'PHASE2_PHASE3') THEN 'PASS' ELSE 'FAIL' END}},
 {{'rule_id': 'trial_dates_consistent', 'severity': 'medium', 'status': CASE WHEN primary_completion IS NULL AND study_completion IS NULL THEN 'SKIP' WHEN coalesce(study_start > study_completion, false) OR coalesce(primary_completion > study_completion, false) THEN 'FAIL' ELSE 'PASS' END}},
 {{'rule_id': 'trial_enrollment_positive', 'severity': 'medium', 'status': CASE WHEN enrollment_count IS NULL THEN 'SKIP' WHEN TRY_CAST(enrollment_count AS INT) > 0 THEN 'PASS' ELSE 'FAIL' END}}]) AS x FROM t), l AS (SELECT id, x.rule_id AS rule_id, x.severity AS severity, x.status AS status FROM r)"""


def _dq(spark, sf_dir) -> DataFrame:
    return quality.check(A.select(spark, sf_dir, TRIAL_ROWS, "orders"), "id", quality.trial_rules())


@query(f"{DQ} SELECT * FROM l")
def dq2_trial_rules(spark, sf_dir):
    return _dq(spark, sf_dir)


@query(f"{DQ} SELECT rule_id, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'WARNING') AS warnings, count(*) FILTER (status = 'SKIP') AS skipped, count(*) FILTER (status = 'FAIL' AND severity = 'critical') AS critical, count(*) FILTER (status = 'FAIL' AND severity = 'high') AS high, round(count(*) FILTER (status = 'PASS') / nullif(CAST(count(*) FILTER (status IN ('PASS', 'FAIL')) AS DOUBLE), 0), 6) AS score FROM l GROUP BY 1")
def ag14_validation_metrics(spark, sf_dir):
    return quality.metrics(_dq(spark, sf_dir), "rule_id").withColumn("score", F.round("score", 6))


COMPANY_ROWS = "SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN lpad(CAST(c_custkey AS VARCHAR(20)), 10, '0') ELSE CAST(c_custkey AS VARCHAR(20)) END AS cik, c_name AS company_name, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'ABC' END AS ticker FROM customer"


@query(f"WITH c AS ({COMPANY_ROWS}) SELECT id, CASE WHEN cik IS NULL OR ticker IS NULL THEN 'FAIL' ELSE 'PASS' END AS company_required_fields, CASE WHEN coalesce(regexp_matches(cik, '^[0-9]{{10}}$'), false) THEN 'PASS' ELSE 'FAIL' END AS company_cik_format, CASE WHEN ticker IS NULL THEN 'SKIP' WHEN regexp_matches(ticker, '^[A-Z]{{1,5}}$') THEN 'PASS' ELSE 'FAIL' END AS company_ticker_format FROM c")
def dq2_company_rules(spark, sf_dir):
    rows = quality.check(A.select(spark, sf_dir, COMPANY_ROWS, "customer"), "id", quality.company_rules())
    return rows.groupBy("id").pivot("rule_id", ["company_required_fields", "company_cik_format", "company_ticker_format"]).agg(F.first("status"))


ESSENTIALS = "SELECT l_orderkey AS id, count(*) > 1 AS endpoints, CASE WHEN min(l_partkey) % 3 <> 0 THEN count(*) END AS total_n, CASE WHEN min(l_suppkey) % 2 = 0 THEN 'ITT' END AS analysed_on, min(l_partkey) % 5 <> 0 AS effect_or_p, min(l_suppkey) % 3 = 0 AS is_pivotal FROM lineitem GROUP BY 1"


@query(f"WITH c AS ({ESSENTIALS}), m AS (SELECT *, CAST(NOT endpoints AS INT) + CAST(total_n IS NULL AS INT) + CAST(analysed_on IS NULL AS INT) + CAST(NOT effect_or_p AS INT) AS n FROM c) SELECT id, n AS missing, CASE n WHEN 0 THEN 'high' WHEN 1 THEN 'med' ELSE 'low' END AS coverage, is_pivotal AND n > 0 AS quarantined FROM m")
def qc9_pivotal_guardrail(spark, sf_dir):
    c = A.select(spark, sf_dir, ESSENTIALS, "lineitem")
    gone = quality.missing_essentials(F.col("endpoints"), F.col("total_n"), F.col("analysed_on"), F.col("effect_or_p"))
    every, bad = quality.split_quarantine(c.withColumn("gone", gone), F.col("is_pivotal"), F.col("gone"))
    return every.join(bad.select("id", F.lit(True).alias("q")), "id", "left").select("id", F.size("gone").alias("missing"), quality.coverage_level(F.col("gone")).alias("coverage"), F.coalesce("q", F.lit(False)).alias("quarantined"))


@query("WITH q AS (SELECT l_orderkey AS id, max(l_discount) * 10 AS a, max(l_tax) * 10 AS b, min(l_discount) * 10 AS c, min(l_tax) * 10 AS d FROM lineitem GROUP BY 1), s AS (SELECT *, round((4e-1 * a + 3e-1 * b + 2e-1 * c + 1e-1 * d) / 1e0, 6) AS score, (a + b + c + d) / 4 AS m FROM q) SELECT id, score, CASE WHEN score >= 9e-1 THEN 10 WHEN score >= 8e-1 THEN 9 WHEN score >= 7e-1 THEN 8 WHEN score >= 6e-1 THEN 7 WHEN score >= 5e-1 THEN 6 WHEN score >= 4e-1 THEN 5 WHEN score >= 3e-1 THEN 4 WHEN score >= 2e-1 THEN 3 WHEN score >= 1e-1 THEN 2 ELSE 1 END AS rank, round(greatest(0e0, least(1e0, score - least(2e-1, ((a - m) * (a - m) + (b - m) * (b - m) + (c - m) * (c - m) + (d - m) * (d - m)) / 4 * 5e-1))), 7) AS confidence FROM s")
def qc2_quality_rank(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"]
    q = line.groupBy(F.col("l_orderkey").alias("id")).agg((F.max("l_discount") * 10).alias("required"), (F.max("l_tax") * 10).alias("evidence"), (F.min("l_discount") * 10).alias("advanced"), (F.min("l_tax") * 10).alias("metadata"))
    parts = {k: F.col(k) for k in quality.CATEGORY_WEIGHTS}
    out = q.withColumn("score", F.round(quality.overall(parts), 6))
    return out.select("id", "score", quality.rank_of(F.col("score")).alias("rank"), F.round(quality.confidence_of(parts, F.col("score")), 7).alias("confidence"))


# --- tables -----------------------------------------------------------------------------------------


@query("WITH o AS (SELECT DISTINCT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS d FROM orders), r AS (SELECT ticker, d AS valid_from, lead(d) OVER (PARTITION BY ticker ORDER BY d) AS valid_to FROM o) SELECT *, CASE WHEN valid_to IS NULL THEN 'active' ELSE 'delisted' END AS status FROM r")
def snk6_valid_ranges(spark, sf_dir):
    o = A.tables(spark, sf_dir, "orders")["orders"].select(F.col("o_custkey").alias("ticker"), F.col("o_orderdate").cast("date").alias("d")).distinct()
    return ops.valid_ranges(o, "ticker", "d").select("ticker", "valid_from", "valid_to", "status")


RANGES = "SELECT DISTINCT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS valid_from, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INT) END AS valid_to FROM orders"


@query(f"WITH r AS (SELECT DISTINCT ticker, valid_from, max(coalesce(valid_to, DATE '9999-12-31')) AS e FROM ({RANGES}) x WHERE valid_to IS NULL OR valid_from < valid_to GROUP BY 1, 2), w AS (SELECT *, max(e) OVER (PARTITION BY ticker ORDER BY valid_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM r) SELECT ticker, valid_from FROM w WHERE valid_from < far")
def jn10_range_overlaps(spark, sf_dir):
    r = A.select(spark, sf_dir, RANGES, "orders").where("valid_to is null or valid_from < valid_to")
    far = F.max(F.coalesce("valid_to", F.lit("9999-12-31").cast("date")))
    one = r.groupBy("ticker", "valid_from").agg(far.alias("valid_to"))
    return ops.overlaps(one, "ticker").select("ticker", "valid_from")


@query("WITH a AS (SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS notes FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT c_custkey AS id, c_mktsegment AS name, CASE WHEN c_custkey % 4 = 0 THEN 'new' END AS notes FROM customer WHERE c_custkey % 3 = 0) SELECT coalesce(b.id, a.id) AS id, CASE WHEN b.id IS NOT NULL THEN b.name ELSE a.name END AS name, coalesce(b.notes, a.notes) AS notes FROM a FULL JOIN b ON a.id = b.id")
def snk1_upsert(spark, sf_dir):
    c = A.tables(spark, sf_dir, "customer")["customer"]
    a = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("string").alias("notes"))
    b = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), F.when(F.col("c_custkey") % 4 == 0, "new").alias("notes"))
    return ops.upsert(a, b, ["id"], ("notes",))


@query("SELECT s_suppkey AS id, 'old' AS origin FROM supplier UNION ALL SELECT p_partkey, 'new' FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def snk2_insert_absent(spark, sf_dir):
    t = A.tables(spark, sf_dir, "supplier", "part")
    return ops.insert_absent(t["supplier"].select(F.col("s_suppkey").alias("id"), F.lit("old").alias("origin")), t["part"].select(F.col("p_partkey").alias("id"), F.lit("new").alias("origin")), ["id"])


OBJECTS = "SELECT p_partkey AS object_id, CASE WHEN p_size % 2 = 0 THEN 'local' ELSE 's3' END AS backend_type, CAST(floor(p_retailprice) AS BIGINT) AS size_bytes, DATE '2024-01-01' + CAST(p_partkey % 60 AS INT) AS last_accessed FROM part"
REFS = "SELECT l_partkey AS object_id, l_returnflag AS reference_type, l_suppkey AS entity_id FROM lineitem WHERE l_partkey % 4 <> 0"


def _counted(spark, sf_dir) -> DataFrame:
    return ops.reference_counts(A.select(spark, sf_dir, OBJECTS, "part"), A.select(spark, sf_dir, REFS, "lineitem"))


COUNTED = f"WITH o AS ({OBJECTS}), r AS (SELECT object_id, count(DISTINCT (reference_type, entity_id)) AS n FROM ({REFS}) x GROUP BY 1), c AS (SELECT o.*, coalesce(r.n, 0) AS refcount FROM o LEFT JOIN r USING (object_id))"


@query(f"{COUNTED} SELECT object_id, refcount FROM c")
def snk8_reference_counts(spark, sf_dir):
    return _counted(spark, sf_dir).select("object_id", "refcount")


@query(f"{COUNTED} SELECT object_id, size_bytes FROM c WHERE refcount <= 0 AND last_accessed < DATE '2024-03-01' - 30")
def st7_cleanup_candidates(spark, sf_dir):
    return ops.cleanup_candidates(_counted(spark, sf_dir), F.lit("2024-03-01").cast("date")).select("object_id", "size_bytes")


@query(f"{COUNTED} SELECT backend_type, count(*) AS objects, CAST(sum(size_bytes) AS BIGINT) AS bytes, count(*) FILTER (refcount = 0) AS unreferenced FROM c GROUP BY ROLLUP (backend_type)")
def ag6_storage_statistics(spark, sf_dir):
    return ops.storage_statistics(_counted(spark, sf_dir))


@query(f"WITH o AS ({OBJECTS}), s AS (SELECT *, sum(size_bytes) OVER (PARTITION BY backend_type ORDER BY last_accessed DESC, object_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM o) SELECT object_id, backend_type FROM s WHERE k > 400000")
def st8_evictions(spark, sf_dir):
    return ops.evictions(A.select(spark, sf_dir, OBJECTS, "part"), "backend_type", 400_000).select("object_id", "backend_type")


# --- monitoring -------------------------------------------------------------------------------------

RUNS = "SELECT event_id AS execution_id, event_type AS pipeline_name, event_type <> 'error' AS success, CAST(floor(value * 10) AS BIGINT) AS records_processed, user_id AS error_count, ts AS start_time, ts + INTERVAL '1' MINUTE AS end_time FROM events"


def _runs(spark, sf_dir) -> DataFrame:
    return monitor.run_metrics(A.select(spark, sf_dir, RUNS, "events").withColumn("end_time", F.expr("start_time + make_dt_interval(0, 0, cast(error_count as int), 0)")))


RUN_METRICS = f"WITH r0 AS ({RUNS}), r AS (SELECT *, error_count * 60e0 AS duration_seconds, CASE WHEN error_count > 0 THEN records_processed / (error_count * 60e0) ELSE 0e0 END AS processing_rate, CASE WHEN records_processed > 0 THEN error_count / CAST(records_processed AS DOUBLE) ELSE 0e0 END AS error_rate FROM r0)"


@query(f"{RUN_METRICS} SELECT execution_id, 'pipeline_failure' AS alert_type, 'critical' AS severity FROM r WHERE NOT success UNION ALL SELECT execution_id, 'error_rate_high', 'high' FROM r WHERE error_rate > 1e-1 UNION ALL SELECT execution_id, 'performance_issue', 'medium' FROM r WHERE duration_seconds > 3600")
def mn2_run_alerts(spark, sf_dir):
    return monitor.run_alerts(_runs(spark, sf_dir))


@query(f"{RUN_METRICS} SELECT pipeline_name, count(*) AS runs, round(avg(CAST(success AS DOUBLE)), 6) AS success_rate, round(avg(duration_seconds), 6) AS mean_duration, round(sum(CASE WHEN processing_rate > 0 THEN processing_rate ELSE 0e0 END) / count(*), 6) AS mean_rate, round(avg(error_rate), 6) AS error_rate FROM r WHERE start_time >= TIMESTAMP '2024-01-28 00:00:00' - INTERVAL 240 HOUR GROUP BY 1")
def ag16_performance(spark, sf_dir):
    out = monitor.performance(_runs(spark, sf_dir), "pipeline_name", F.lit("2024-01-28 00:00:00").cast("timestamp"), 240)
    return out.select("pipeline_name", "runs", *(F.round(c, 6).alias(c) for c in ("success_rate", "mean_duration", "mean_rate", "error_rate")))


@query("SELECT round(avg(value), 6) AS mean, max(value) AS peak, arg_max(value, ts) AS current FROM events")
def ag17_system_summary(spark, sf_dir):
    return monitor.system_summary(A.tables(spark, sf_dir, "events")["events"], "value").withColumn("mean", F.round("mean", 6))


@query("SELECT user_id AS alert_id, arg_max(event_type, ts) AS state, max(ts) AS since FROM events GROUP BY 1 HAVING arg_max(event_type, ts) <> 'view'")
def mn3_open_alerts(spark, sf_dir):
    e = A.tables(spark, sf_dir, "events")["events"].select(F.col("user_id").alias("alert_id"), "ts", F.when(F.col("event_type") == "view", "resolved").otherwise(F.col("event_type")).alias("action"))
    return monitor.open_alerts(e)


# --- aggregates and sets ----------------------------------------------------------------------------


@query("SELECT l_orderkey AS trial_id, count(*) AS evaluators, round(avg(l_linenumber), 6) AS mean_score, quantile_cont(CAST(l_linenumber AS DOUBLE), 0.5) AS median_score, min(l_linenumber) AS min_score, max(l_linenumber) AS max_score, round(stddev_samp(l_linenumber), 6) AS score_stddev, max(l_shipdate) AS last_updated FROM lineitem GROUP BY 1")
def ag1_rankings(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"]
    return line.groupBy(F.col("l_orderkey").alias("trial_id")).agg(F.count("*").alias("evaluators"), F.round(F.avg("l_linenumber"), 6).alias("mean_score"), F.percentile("l_linenumber", 0.5).alias("median_score"), F.min("l_linenumber").alias("min_score"), F.max("l_linenumber").alias("max_score"), F.round(F.stddev_samp("l_linenumber"), 6).alias("score_stddev"), F.max("l_shipdate").alias("last_updated"))


@query("SELECT l_linenumber AS score, count(*) AS n, round(avg(l_discount), 6) AS mean_confidence FROM lineitem GROUP BY 1")
def ag7_rank_distribution(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"]
    return line.groupBy(F.col("l_linenumber").alias("score")).agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("mean_confidence"))


@query("SELECT dim, value, count(*) AS n FROM (SELECT unnest([{'d': 'flag', 'v': l_returnflag}, {'d': 'status', 'v': l_linestatus}, {'d': 'line', 'v': CAST(l_linenumber AS VARCHAR)}], recursive := true) FROM lineitem) x(dim, value) GROUP BY 1, 2")
def ag10_distributions(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"]
    rows = F.explode(F.array(F.struct(F.lit("flag").alias("dim"), F.col("l_returnflag").alias("value")), F.struct(F.lit("status").alias("dim"), F.col("l_linestatus").alias("value")), F.struct(F.lit("line").alias("dim"), F.col("l_linenumber").cast("string").alias("value"))))
    return line.select(rows.alias("r")).groupBy("r.dim", "r.value").agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT s_suppkey AS id FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal BETWEEN 1000 AND 8000 AND n_regionkey IN (0, 1, 2) AND n_name NOT IN ('NATION_3', 'NATION_4')), k AS (SELECT l_suppkey AS id, count(DISTINCT l_orderkey) AS trials FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 100) SELECT id, trials FROM c JOIN k USING (id)")
def prj7_company_filter(spark, sf_dir):
    t = A.tables(spark, sf_dir, "supplier", "nation", "lineitem")
    c = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).where(F.col("s_acctbal").between(1000, 8000) & F.col("n_regionkey").isin(0, 1, 2) & ~F.col("n_name").isin("NATION_3", "NATION_4")).select(F.col("s_suppkey").alias("id"))
    k = t["lineitem"].groupBy(F.col("l_suppkey").alias("id")).agg(F.countDistinct("l_orderkey").alias("trials")).where("trials >= 100")
    return c.join(k, "id")


@query("WITH d AS (SELECT o_custkey AS trial_id, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS p FROM orders GROUP BY 1), e AS (SELECT l_suppkey AS trial_id, array_to_string(list_sort(list(DISTINCT l_returnflag)), '|') AS p FROM lineitem GROUP BY 1) SELECT * FROM d UNION ALL SELECT * FROM e")
def st1_union_all(spark, sf_dir):
    t = A.tables(spark, sf_dir, "orders", "lineitem")
    sets = lambda df, k, v: df.groupBy(F.col(k).alias("trial_id")).agg(F.array_join(F.array_sort(F.collect_set(v)), "|").alias("p"))
    return sets(t["orders"], "o_custkey", "o_orderpriority").unionByName(sets(t["lineitem"], "l_suppkey", "l_returnflag"))


@query("WITH a AS (SELECT l_suppkey AS id, list_sort(list(DISTINCT l_linenumber) FILTER (l_returnflag = 'A')) AS x, list_sort(list(DISTINCT l_linenumber) FILTER (l_returnflag = 'R' AND l_discount > 0.05)) AS y FROM lineitem GROUP BY 1) SELECT id, array_to_string(list_sort(list_filter(y, lambda v: NOT list_contains(x, v))), ',') AS added, array_to_string(list_sort(list_filter(x, lambda v: NOT list_contains(y, v))), ',') AS removed FROM a")
def st4_set_difference(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"]
    n = F.col("l_linenumber").cast("string")
    sets = line.groupBy(F.col("l_suppkey").alias("id")).agg(F.collect_set(F.when(F.col("l_returnflag") == "A", n)).alias("x"), F.collect_set(F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05), n)).alias("y"))
    from lodestar.operators.versions import array_changes

    out = sets.select("id", array_changes(F.col("x"), F.col("y")).alias("c"))
    return out.select("id", F.array_join(F.array_sort("c.added"), ",").alias("added"), F.array_join(F.array_sort("c.removed"), ",").alias("removed"))
