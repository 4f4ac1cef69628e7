"""Queries over filing events, JSON study cards and queues, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import filings
from lodestar.plans import adapters as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def from_orders(columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{x} AS {c}' for c, x in columns.items())} FROM orders"


def json_cards(spark, sf_dir, columns: dict[str, str]):
    orders = A.tables(spark, sf_dir, "orders")["orders"]
    return orders.selectExpr(*(f"{x} AS {c}" for c, x in columns.items())).withColumn("card", F.parse_json("card"))


PATHS = {
    "id": """o_orderkey""",
    "card": """'{"primary":{"type":"' || o_orderstatus || '","0":"zero"},"arms":[' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '{"label":"a' || CAST(o_orderkey % 5 AS VARCHAR(20)) || '"},{"label":"b"}' END || '],"note":' || CASE o_orderkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"x"' ELSE '7' END || CASE WHEN o_orderkey % 2 = 0 THEN ',"odd key":true' ELSE '' END || '}'""",
}


@query(f"WITH c AS ({from_orders(PATHS)}) SELECT id, json_extract_string(card, '$.arms[0].label') AS first_label, json_extract_string(card, '$.arms[1].label') AS second_label, json_extract_string(card, '$.primary.0') AS zero, json_extract_string(card, '$.note') AS note, list_contains(json_keys(card), 'note') AS has_note, list_contains(json_keys(card), 'odd key') AS has_odd, false AS has_gone, CAST(json_array_length(card, '$.arms') AS INT) AS arms FROM c")
def prj3_card_paths(spark, sf_dir):
    c = F.col("card")
    return json_cards(spark, sf_dir, PATHS).select(
        "id", filings.value_at(c, "arms.*.label").alias("first_label"), filings.value_by_index(c, "arms.1.label").alias("second_label"), filings.value_by_index(c, "primary.0").alias("zero"), filings.value_at(c, "note").alias("note"),
        filings.has_key(c, "note").alias("has_note"), filings.has_key(c, "odd key").alias("has_odd"), filings.has_key(c, "primary.gone").alias("has_gone"), filings.array_length(c, "arms").alias("arms"),
    )


NOTES = {
    "study_id": """o_orderkey""",
    "trial_id": """o_custkey""",
    "card": """CASE WHEN o_orderkey % 7 <> 0 THEN '{}' END""",
    "tone": """'{"overall_tone":"' || o_orderpriority || '"}'""",
    "pub": """'{"journal_type":"' || o_orderstatus || '","open_access":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END || '}'""",
    "notes": """CASE WHEN o_orderkey % 3 <> 0 THEN '{"quality_assessment":{"overall_quality":"high"},"limitations":[1,2],"oddities":[' || CASE WHEN o_orderkey % 5 = 0 THEN '"x"' ELSE '' END || ']}' END""",
}


@query(f"WITH s AS ({from_orders(NOTES)}) SELECT study_id, trial_id, json_extract_string(tone, '$.overall_tone') AS overall_tone, json_extract_string(pub, '$.journal_type') AS journal_type, json_extract_string(pub, '$.open_access') AS open_access, json_extract_string(notes, '$.quality_assessment.overall_quality') AS reviewer_quality_rating, CAST(NULL AS VARCHAR) AS evidence_strength, 0 AS conflicts_count, 0 AS funding_sources_count, CAST(coalesce(json_array_length(notes, '$.limitations'), 0) AS INT) AS limitations_count, CAST(coalesce(json_array_length(notes, '$.oddities'), 0) AS INT) AS oddities_count, 0 AS quote_spans_count FROM s WHERE card IS NOT NULL")
def prj10_card_view(spark, sf_dir):
    s = json_cards(spark, sf_dir, NOTES)
    none = F.parse_json(F.lit("{}"))
    s = s.select("study_id", "trial_id", F.col("card").alias("extracted_jsonb"), F.parse_json("tone").alias("tone_analysis"), F.parse_json("pub").alias("publication_details"), F.parse_json("notes").alias("reviewer_notes"), none.alias("conflicts_and_funding"), none.alias("data_location_mapping"))
    return filings.card_view(s)


RAW = {
    "id": """o_orderkey""",
    "card": """'{"phase":" Phase ' || o_orderstatus || ' ","is_pivotal":' || CASE o_orderkey % 4 WHEN 0 THEN '"YES"' WHEN 1 THEN '0' WHEN 2 THEN 'true' ELSE '"no"' END || ',"sample_size":"' || CASE WHEN o_orderkey % 3 = 0 THEN 'many' ELSE CAST(o_custkey AS VARCHAR(20)) || '.7' END || '","arms":{"t":{"n":"12.9","dropout":' || CASE WHEN o_orderkey % 2 = 0 THEN '1.5' ELSE '"bad"' END || '}},"analysis_plan":{"alpha":' || CASE o_orderkey % 3 WHEN 0 THEN '5' WHEN 1 THEN '0' ELSE 'null' END || ',"planned_interims":-2},"primary_result":{"itt":{"p":1.2,"estimate":"0.5"}}}'""",
}


@query("SELECT o_orderkey AS id, 'phase ' || lower(o_orderstatus) AS phase, o_orderkey % 4 IN (0, 2) AS is_pivotal, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS BIGINT) END AS sample_size, CAST(12 AS BIGINT) AS arm_n, CASE WHEN o_orderkey % 2 = 0 THEN 1e0 ELSE 0e0 END AS dropout, CASE o_orderkey % 3 WHEN 0 THEN 999e-3 WHEN 1 THEN 1e-3 ELSE 5e-2 END AS alpha, CAST(0 AS BIGINT) AS interims, 1e0 AS p, 5e-1 AS estimate, CAST(NULL AS VARCHAR) AS sponsor FROM orders")
def qc11_normalised_card(spark, sf_dir):
    c = json_cards(spark, sf_dir, RAW).select("id", filings.normalised_card(F.col("card")).alias("c"))
    return c.select("id", "c.phase", "c.is_pivotal", "c.sample_size", F.col("c.arms")["t"]["n"].alias("arm_n"), F.col("c.arms")["t"]["dropout"].alias("dropout"), "c.alpha", F.col("c.planned_interims").alias("interims"), F.col("c.primary_result")["itt"]["p"].alias("p"), F.col("c.primary_result")["itt"]["estimate"].alias("estimate"), "c.sponsor")


READOUT = {
    "id": """o_orderkey""",
    "card": """'{"readout":{' || CASE o_orderkey % 3 WHEN 0 THEN '"expected_date":"2025-03-10"' WHEN 1 THEN '"conference":{"name":"ASCO","year":2025}' ELSE '"expected_date":"soon"' END || '}' || CASE WHEN o_orderkey % 2 = 0 THEN ',"quoted_text":"data in Q3 2026"' ELSE '' END || '}'""",
}


@query("SELECT id, kind, CAST(s AS DATE) AS window_start, CAST(t AS DATE) AS window_end, weight FROM (SELECT o_orderkey AS id, 'exact_date' AS kind, '2025-03-09' AS s, '2025-03-12' AS t, 95e-2 AS weight FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 'conference', '2025-05-30', '2025-06-06', 8e-1 FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT o_orderkey, 'freeform', '2026-07-01', '2026-09-30', 6e-1 FROM orders WHERE o_orderkey % 2 = 0) x")
def ct2_card_hints(spark, sf_dir):
    h = json_cards(spark, sf_dir, READOUT).select("id", F.explode(filings.hints(F.col("card"))).alias("h"))
    return h.select("id", "h.kind", F.col("h.start").alias("window_start"), F.col("h.end").alias("window_end"), "h.weight")


ITEMS = """SELECT l_orderkey AS filing_id, l_linenumber AS item, CASE l_partkey % 6 WHEN 0 THEN 'endpoint_met' WHEN 1 THEN 'safety_signal' WHEN 2 THEN 'enrollment' WHEN 3 THEN 'regulatory_hold' WHEN 4 THEN 'update' END AS event, CASE WHEN l_suppkey % 3 = 0 THEN 'NCT' || CAST(l_suppkey AS VARCHAR(20)) END AS trial_identifier, CASE WHEN l_partkey % 5 = 0 THEN 'met' END AS outcome, CASE WHEN l_partkey % 7 = 0 THEN 'death' END AS safety, CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_linenumber AS DOUBLE) / 8e0 END AS confidence, l_suppkey % 13 = 0 AS requires_review FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber) x"""
REVIEW = "coalesce(confidence, 0) < 7e-1 OR requires_review"


def _items(spark, sf_dir):
    one = lambda c: F.array_compact(F.array(F.col(c)))
    return A.select(spark, sf_dir, ITEMS, "lineitem").withColumns({"trial_events": one("event"), "endpoints_mentioned": one("outcome"), "safety_signals": one("safety"), "clinical_development": one("event"), "regulatory_updates": one("outcome")})


@query(f"WITH i AS ({ITEMS}) SELECT filing_id, item, coalesce(event, 'unknown') AS event_type, coalesce(event, '') AS event_description, ({REVIEW} OR (coalesce(event, '') IN ('endpoint_met', 'safety_signal') AND trial_identifier IS NULL)) AS needs_review, (coalesce(event, '') IN ('endpoint_met', 'safety_signal', 'regulatory_hold') OR outcome IS NOT NULL OR safety IS NOT NULL) AS triggers_signals FROM i")
def or3_trial_events(spark, sf_dir):
    return filings.trial_events(_items(spark, sf_dir)).select("filing_id", "item", "event_type", "event_description", "needs_review", "triggers_signals")


@query(f"WITH i AS ({ITEMS}) SELECT 'trial_event_' || filing_id || '_' || item AS item_id, 'trial_event' AS item_type, coalesce(confidence, 0e0) AS confidence FROM i WHERE item % 2 = 1 AND ({REVIEW} OR (coalesce(event, '') IN ('endpoint_met', 'safety_signal') AND trial_identifier IS NULL)) UNION ALL SELECT 'clinical_update_' || filing_id || '_' || item, 'clinical_update', coalesce(confidence, 0e0) FROM i WHERE item % 2 = 0 AND ({REVIEW})")
def prj14_review_items(spark, sf_dir):
    i = _items(spark, sf_dir)
    found = filings.review_items(filings.trial_events(i.where("item % 2 = 1")), filings.clinical_updates(i.where("item % 2 = 0")))
    return found.select("item_id", "item_type", "confidence")


@query("SELECT o_orderkey AS nct_id, 'Sponsor ' || o_custkey AS sponsor_text FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderstatus <> 'P' AND o_custkey % 5 <> 0 ORDER BY 1 LIMIT 25")
def prj16_unlinked_trials(spark, sf_dir):
    t = A.tables(spark, sf_dir, "orders")["orders"]
    company = F.when(F.col("o_orderkey") % 3 == 0, 0).when(F.col("o_orderkey") % 3 == 1, 9)
    sponsor = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Sponsor "), F.col("o_custkey").cast("string")))
    ignore = spark.createDataFrame([("[05]$",), ("^nobody",)], "pattern string")
    return filings.unlinked_trials(t.select(F.col("o_orderkey").alias("nct_id"), sponsor.alias("sponsor_text"), company.alias("sponsor_company_id")), ignore)


@query("SELECT p_partkey AS id, CASE WHEN regexp_matches(lower(p_name), '\\bred\\b') THEN 1 WHEN regexp_matches(lower(p_name), 'blue|green') THEN 2 END AS company_id FROM part")
def prj9_first_pattern(spark, sf_dir):
    p = A.tables(spark, sf_dir, "part")["part"]
    return p.select(F.col("p_partkey").alias("id"), filings.first_pattern(F.upper("p_name"), [(r"\bred\b", 1), ("blue|green", 2)]).alias("company_id"))


RISK_NOTES = "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'human' ELSE 'auto_evaluator' END AS evaluator_id, o_orderkey % 4 AS k FROM orders"


@query(f"WITH r AS (SELECT k FROM ({RISK_NOTES}) x WHERE evaluator_id = 'auto_evaluator'), n AS (SELECT count(*) FILTER (k IN (0, 3)) AS h, count(*) FILTER (k = 1) AS m, count(*) FILTER (k IN (0, 1)) AS u, count(*) FILTER (k = 0) AS e FROM r) SELECT * FROM (SELECT 'level' AS kind, 'high' AS name, h AS n FROM n UNION ALL SELECT 'level', 'medium', m FROM n UNION ALL SELECT 'level', 'low', 0 FROM n UNION ALL SELECT 'factor', 'underpowered_study', u FROM n UNION ALL SELECT 'factor', 'missing_evidence', e FROM n) x WHERE kind = 'level' OR n > 0")
def ag8_risk_summary(spark, sf_dir):
    k = F.col("k")
    note = F.when(k == 0, "Score 3\nHigh-risk factors: underpowered_study, missing_evidence").when(k == 1, "Medium-risk factors: UNDERPOWERED_STUDY").when(k == 3, "High-risk factors: none, Low-risk factors: none")
    return filings.risk_summary(A.select(spark, sf_dir, RISK_NOTES, "orders").withColumn("reasoning_text", note))


def _tones(spark, sf_dir):
    o = A.tables(spark, sf_dir, "orders")["orders"]
    claims = F.map_from_arrays(F.array(F.lit("os"), F.lit("pfs")), F.array(F.col("o_orderstatus"), F.lit("weak")))
    words = F.when(F.col("o_orderkey") % 3 == 0, F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.concat_ws("-", F.col("o_orderkey").cast("string"), i.cast("string"))))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("overall_tone"), claims.alias("claim_strength"), words.alias("cautious_language"), ((F.col("o_orderkey") % 64) / 128.0).alias("confidence"))


@query("SELECT 'tone' AS section, '' AS key, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 3 UNION ALL SELECT 'claim', 'os', o_orderstatus, count(*) FROM orders GROUP BY 3 UNION ALL SELECT 'claim', 'pfs', 'weak', count(*) FROM orders")
def ag12_tone_distribution(spark, sf_dir):
    return filings.tone_distribution(_tones(spark, sf_dir))


@query("SELECT min((o_orderkey % 64) / 128e0) AS min, max((o_orderkey % 64) / 128e0) AS max, round(sum((o_orderkey % 64) / 128e0) / count(*), 9) AS avg FROM orders")
def ag12_tone_confidence(spark, sf_dir):
    return filings.tone_confidence(_tones(spark, sf_dir)).withColumn("avg", F.round("avg", 9))


@query("SELECT o_orderkey AS id, CAST(i - 1 AS INT) AS place, o_orderkey || '-' || i AS example FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) o CROSS JOIN (VALUES (1), (2), (3)) v(i) ORDER BY o_orderkey, i LIMIT 10")
def ag12_tone_examples(spark, sf_dir):
    return filings.tone_examples(_tones(spark, sf_dir), "cautious_language", "id")


@query("SELECT c_custkey AS company_id, CAST(o_orderdate AS DATE) AS filing_date, o_orderkey AS accession, l_linenumber AS local_path, CASE WHEN l_linenumber = 1 THEN 'ex-21.1' ELSE '' END AS doc_type FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O') AND CAST(o_orderdate AS DATE) >= DATE '1995-01-01' AND l_linenumber IN (1, 3) ORDER BY 2 DESC, 3, 4 LIMIT 100")
def src9_subsidiary_exhibits(spark, sf_dir):
    t = A.tables(spark, sf_dir, "orders", "customer", "lineitem")
    form = F.when(F.col("o_orderstatus") == "F", "10-K").when(F.col("o_orderstatus") == "O", "20-F").otherwise("8-K")
    f = t["orders"].select(F.format_string("%010d", F.col("o_custkey").cast("long")).alias("cik"), form.alias("form"), F.to_date("o_orderdate").alias("filing_date"), F.col("o_orderkey").alias("accession"))
    n = F.col("l_linenumber")
    d = t["lineitem"].select("l_orderkey", "l_linenumber").distinct().select(F.col("l_orderkey").alias("accession"), F.when(n == 1, "ex-21.1").when(n == 2, "ex-99").alias("doc_type"), F.when(n == 3, "List of Subsidiaries").alias("description"), n.alias("local_path"))
    out = filings.subsidiary_exhibits(f, t["customer"].select(F.col("c_custkey").alias("company_id"), F.col("c_custkey").cast("long").alias("cik")), d, F.lit("1995-01-01").cast("date"))
    return out.select("company_id", "filing_date", "accession", "local_path", "doc_type")


@query("SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'nova ' || s_suppkey WHEN 1 THEN 'nova group ' || s_suppkey || ' one' WHEN 2 THEN '' ELSE 'neo 3' END AS norm FROM supplier")
def er1b_norm_in_text(spark, sf_dir):
    k, n = F.col("s_suppkey") % 4, F.col("s_suppkey").cast("string")
    name = F.when(k == 0, F.concat(F.lit("Nova "), n, F.lit(" Therapeutics, Inc."))).when(k == 1, F.concat(F.lit("NOVA Group-"), n, F.lit(" (One)"))).when(k == 2, "Bio Pharma Co.").otherwise("Néo 3 Sciences BV")
    return A.tables(spark, sf_dir, "supplier")["supplier"].select(F.col("s_suppkey").alias("id"), filings.norm_in_text(name).alias("norm"))


@query("WITH r AS (SELECT o_custkey AS cik, o_orderpriority AS name, CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders), m AS (SELECT c_custkey AS company_id, lower(name) AS alias_norm, min(d) AS date_from FROM r JOIN customer ON cik = c_custkey WHERE c_custkey % 2 = 0 GROUP BY 1, 2) SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = company_id AND lower(o.o_orderpriority) = alias_norm AND o.o_orderkey % 5 = 0)")
def er21_former_names(spark, sf_dir):
    t = A.tables(spark, sf_dir, "orders", "customer")
    o = t["orders"]
    rows = o.select(F.col("o_custkey").alias("cik"), F.col("o_orderpriority").alias("name"), F.to_date("o_orderdate").alias("date_from"), F.lit(None).cast("date").alias("date_to"))
    known = o.where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("company_id"), F.lower("o_orderpriority").alias("alias_norm"), F.lit("former_name").alias("alias_type"))
    companies = t["customer"].where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("cik"), F.col("c_custkey").alias("company_id"))
    return filings.former_names(rows, companies, known).select("company_id", "alias_norm", "date_from")


RULED = "SELECT o_orderkey AS trial_id, o_custkey AS enrollment, DATE '2020-01-01' AS start_date, CASE o_orderkey % 3 WHEN 0 THEN DATE '2020-01-11' WHEN 1 THEN DATE '2022-01-01' END AS completion_date, CASE o_orderkey % 4 WHEN 0 THEN 'PHASE1' WHEN 1 THEN 'PHASE3' WHEN 2 THEN 'NA' END AS phase, 'PHASE2' AS last_phase, CASE WHEN o_orderkey % 5 <> 0 THEN 'x' END AS sponsor_text, CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS company_id FROM orders"


@query(f"WITH t AS ({RULED}) SELECT trial_id, 'enrollment_targets' AS rule, CASE WHEN enrollment BETWEEN 10 AND 100000 THEN 'pass' ELSE 'fail' END AS outcome FROM t UNION ALL SELECT trial_id, 'trial_duration', CASE trial_id % 3 WHEN 0 THEN 'fail' WHEN 1 THEN 'pass' ELSE 'skip' END FROM t UNION ALL SELECT trial_id, 'trial_phase_progression', CASE phase WHEN 'PHASE1' THEN 'fail' WHEN 'PHASE3' THEN 'pass' ELSE 'skip' END FROM t UNION ALL SELECT trial_id, 'sponsor_company_link', CASE WHEN sponsor_text IS NULL THEN 'skip' WHEN company_id IS NULL THEN 'fail' ELSE 'pass' END FROM t")
def dq3_business_rules(spark, sf_dir):
    return filings.business_rules(A.select(spark, sf_dir, RULED, "orders"), run=True)
