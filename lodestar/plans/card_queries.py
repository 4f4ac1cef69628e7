"""Queries over JSON study cards: fields, validation, errors, metadata and enrichment, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import cards
from lodestar.plans import adapters as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


STUDY = """'{"trial":{' || CASE o_orderkey % 3 WHEN 0 THEN '"nct_id":"NCT01234567",' WHEN 1 THEN '"nct_id":"NCT12",' ELSE '' END
 || '"phase":' || CASE o_orderkey % 4 WHEN 0 THEN '"3"' WHEN 1 THEN '"9"' WHEN 2 THEN '5' ELSE 'null' END
 || ',"indication":"' || CASE o_orderkey % 5 WHEN 0 THEN 'ab' WHEN 1 THEN ' ' ELSE 'solid tumor' END || '","is_pivotal":' || CASE o_orderkey % 7 WHEN 0 THEN '"yes"' ELSE 'true' END
 || ',"start_date":"' || CASE o_orderkey % 2 WHEN 0 THEN '2024-01-02' ELSE 'soon' END || '","completion_date":2025},"primary_endpoints":'
 || CASE o_orderkey % 6 WHEN 0 THEN '[]' WHEN 1 THEN '[{"name":"a","evidence":"x","deep":{"text_preview":"short"}}]' WHEN 2 THEN '"one"' ELSE '[{"name":"a","loc":{"page":3}},{"name":"b","more":[{"source":"s"}]}]' END
 || ',"populations":{"itt":{"n":1},"pp":' || CASE o_orderkey % 8 WHEN 0 THEN '{"defined":true,"criteria":"c"}' WHEN 1 THEN '{}' ELSE '{"defined":false,"criteria":"c"}' END
 || ',"analysis_primary_on":"' || CASE o_orderkey % 9 WHEN 0 THEN 'ITT' ELSE 'PP' END || '"},"results":{"primary":[{"p":0.1,"text_preview":"longer than ten"}]},"sample_size":'
 || CASE o_orderkey % 10 WHEN 0 THEN '{"total_n":0,"power":0.9}' WHEN 1 THEN '40' WHEN 2 THEN '"many"' WHEN 3 THEN '{"power":"high"}' ELSE '{"total_n":250,"power":0.4}' END || ',"publication":{"open_access":false,"doi":" "}}'"""


def studies(spark, sf_dir):
    keys = A.spread(A.tables(spark, sf_dir, "orders")["orders"].select("o_orderkey"))
    base = keys.selectExpr("o_orderkey AS id", f"{STUDY} AS card_text")
    return base.select("id", "card_text", F.parse_json("card_text").alias("card"))


TABLE = ", ".join(f"('{n}', '$.{p}', '{k}', {str(r).lower()})" for n, p, k, r in cards.FIELDS)
#: Each field of each card with its JSON type; the same rules told over json_type.
FOUND = f"""(WITH c AS (SELECT o_orderkey AS id, {STUDY} AS card FROM orders), f(field, path, kind, needed) AS (VALUES {TABLE}),
  x AS (SELECT id, f.*, nullif(json_type(card, path), 'NULL') AS jt, json_extract_string(card, path) AS s, json_array_length(card, path) AS n, len(json_keys(card, path)) AS k FROM c, f)
  SELECT id, field, kind AS type, jt, s, CASE WHEN jt IS NULL THEN 'missing'
    WHEN kind = 'text' THEN CASE WHEN jt <> 'VARCHAR' THEN 'invalid' WHEN trim(s) = '' THEN 'partial' ELSE 'extracted' END
    WHEN kind = 'number' THEN CASE WHEN jt IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN') THEN 'extracted' ELSE 'missing' END
    WHEN kind = 'boolean' THEN CASE WHEN jt = 'BOOLEAN' THEN 'extracted' ELSE 'invalid' END
    WHEN kind = 'date' THEN CASE WHEN jt IN ('UBIGINT', 'BIGINT', 'DOUBLE') OR regexp_matches(s, '^([0-9]{{4}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})') THEN 'extracted' ELSE 'invalid' END
    WHEN kind = 'array' THEN CASE WHEN jt <> 'ARRAY' THEN 'invalid' WHEN n = 0 THEN 'partial' ELSE 'extracted' END
    ELSE CASE WHEN jt <> 'OBJECT' THEN 'invalid' WHEN k = 0 THEN 'partial' ELSE 'extracted' END END AS status
  FROM x WHERE jt IS NOT NULL OR needed)"""
CONFIDENCE = "CASE status WHEN 'extracted' THEN 1.0 WHEN 'partial' THEN CASE type WHEN 'text' THEN 0.3 ELSE 0.5 END ELSE 0.0 END"


@query(f"SELECT id, field, type, status, CAST({CONFIDENCE} AS DOUBLE) AS confidence FROM {FOUND}")
def qc5_card_fields(spark, sf_dir):
    return studies(spark, sf_dir).select("id", F.explode(cards.fields(F.col("card"))).alias("f")).select("id", "f.field", "f.type", "f.status", "f.confidence")


@query(
    "SELECT id, field, field_path, evidence_type, value FROM (SELECT o_orderkey AS id, unnest(list_concat(CASE o_orderkey % 6 WHEN 0 THEN [] WHEN 2 THEN [] "
    "WHEN 1 THEN [{'field': 'primary_endpoints', 'field_path': 'primary_endpoints[0]', 'evidence_type': 'evidence', 'value': 'x'}, {'field': 'primary_endpoints', 'field_path': 'primary_endpoints[0].deep', 'evidence_type': 'text_preview', 'value': 'short'}] "
    "ELSE [{'field': 'primary_endpoints', 'field_path': 'primary_endpoints[0]', 'evidence_type': 'loc', 'value': '{\"page\": 3}'}, {'field': 'primary_endpoints', 'field_path': 'primary_endpoints[1].more[0]', 'evidence_type': 'source', 'value': 's'}] END, "
    "[{'field': 'primary_results', 'field_path': 'results.primary[0]', 'evidence_type': 'text_preview', 'value': 'longer than ten'}]), recursive := true) FROM orders)"
)
def qc6_evidence_spans(spark, sf_dir):
    return studies(spark, sf_dir).select("id", F.explode(cards.evidence(F.col("card_text"))).alias("e")).select("id", "e.field", "e.field_path", "e.evidence_type", "e.value")


@query(
    f"""WITH f AS (SELECT * FROM {FOUND}), s AS (SELECT id, count(*) AS n, count(*) FILTER (status = 'extracted') + 0.5 * count(*) FILTER (status = 'partial') AS done FROM f GROUP BY id),
  i AS (SELECT id, CASE WHEN id % 3 = 2 THEN 1 ELSE 0 END + CASE WHEN id % 4 = 3 THEN 1 ELSE 0 END + CASE WHEN id % 3 = 1 THEN 1 ELSE 0 END + CASE WHEN id % 10 IN (0, 2, 3) THEN 1 ELSE 0 END AS errors,
    CASE WHEN id % 4 IN (1, 2) THEN 1 ELSE 0 END + CASE WHEN id % 5 IN (0, 1) THEN 1 ELSE 0 END + CASE WHEN id % 10 >= 3 THEN 1 ELSE 0 END + CASE WHEN id % 6 IN (0, 2) THEN 1 ELSE 0 END
    + CASE WHEN id % 9 <> 0 AND id % 8 > 1 THEN 1 ELSE 0 END + CASE WHEN id % 6 NOT IN (0, 1) THEN 1 ELSE 0 END + CASE WHEN id % 6 = 1 THEN 1 ELSE 0 END AS warnings FROM (SELECT o_orderkey AS id FROM orders)),
  v AS (SELECT id, errors, warnings, greatest(0, 100 - 10 * errors - 2 * warnings) AS score FROM i)
  SELECT id, CAST(errors AS INT) AS errors, CAST(warnings AS INT) AS warnings, CAST(score AS INT) AS score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade,
    round(CAST(score * 0.7 + done / n * 30 AS DOUBLE), 6) AS overall FROM v JOIN s USING (id)"""
)
def qc7_card_validation(spark, sf_dir):
    found = studies(spark, sf_dir).withColumn("e", cards.evidence(F.col("card_text")))
    checked = found.select("id", cards.issues(F.col("card"), F.col("e")).alias("i"), cards.fields_summary(cards.fields(F.col("card"))).alias("s"))
    return checked.select("id", cards.validation(F.col("i"), F.col("s")).alias("v")).select("id", "v.errors", "v.warnings", "v.score", "v.grade", F.round("v.overall", 6).alias("overall"))


RAW = """'{' || CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '"study_id":"  ",' ELSE '"study_id":"s' || CAST(o_orderkey AS VARCHAR(20)) || '",' END || '"is_pivotal":true,"primary_type":' || CASE o_orderkey % 4 WHEN 0 THEN 'null' ELSE '"tte"' END
 || ',"sponsor":"' || CASE o_orderkey % 2 WHEN 0 THEN 'Pfizer' ELSE 'Acme' END || '","indication":"' || CASE o_orderkey % 3 WHEN 0 THEN 'Lung Cancer' WHEN 1 THEN 'asthma' ELSE 'x' END || '","phase":"' || CASE o_orderkey % 3 WHEN 0 THEN 'Phase_3' WHEN 1 THEN 'phase_2a' ELSE '?' END
 || '","arms":' || CASE o_orderkey % 7 WHEN 0 THEN '[]' WHEN 1 THEN '{}' WHEN 2 THEN '{"a":{"n":"12"},"b":{"n":0}}' WHEN 3 THEN '{"a":{"dropout":"x"},"b":3}' ELSE '{"a":{"n":' || CAST(o_orderkey % 90 + 20 AS VARCHAR(20)) || '},"b":{"n":30}}' END
 || ',"analysis_plan":{"alpha":' || CASE o_orderkey % 6 WHEN 0 THEN '"none"' WHEN 1 THEN '1.5' ELSE '0.05' END || ',"planned_interims":' || CAST(o_orderkey % 13 AS VARCHAR(20)) || '},"primary_result":{"itt":{"p":' || CASE o_orderkey % 8 WHEN 0 THEN '2' ELSE '0.01' END || '}},"subgroups":['
 || CASE o_orderkey % 9 WHEN 0 THEN '{"n":1},{"name":"k"}' WHEN 1 THEN '1' ELSE '' END || ']}'"""
RAWS = "(SELECT o_orderkey AS id FROM orders)"


def raw(spark, sf_dir):
    keys = A.spread(A.tables(spark, sf_dir, "orders")["orders"].select("o_orderkey"))
    return keys.selectExpr("o_orderkey AS id", f"parse_json({RAW}) AS card")


@query(
    "SELECT id, unnest(list_filter(["
    "CASE WHEN id % 5 = 0 THEN 'Missing required field: study_id' END, CASE WHEN id % 4 = 0 THEN 'Missing required field: primary_type' END, CASE WHEN id % 5 = 1 THEN 'Study ID cannot be empty' END, "
    "CASE id % 7 WHEN 0 THEN 'Arms must be a dictionary' WHEN 1 THEN 'Arms dictionary cannot be empty' WHEN 2 THEN 'Arm b sample size must be positive' WHEN 3 THEN 'Arm a missing sample size (n)' END, CASE WHEN id % 7 = 3 THEN 'Arm b must be a dictionary' END, "
    "CASE id % 6 WHEN 0 THEN 'Alpha must be a valid number' WHEN 1 THEN 'Alpha must be between 0 and 1' END, CASE WHEN id % 13 > 10 THEN 'Planned interims too high (max 10)' END, CASE WHEN id % 8 = 0 THEN 'P-value in itt must be between 0 and 1' END, "
    f"CASE id % 9 WHEN 0 THEN 'Subgroup 0 missing name' WHEN 1 THEN 'Subgroup 0 must be a dictionary' END, CASE WHEN id % 9 = 0 THEN 'Subgroup 1 missing sample size' END], lambda m: m IS NOT NULL)) AS error FROM {RAWS}"
)
def qc12_card_errors(spark, sf_dir):
    return raw(spark, sf_dir).select("id", F.explode(cards.card_errors(F.col("card"))).alias("error"))


@query(
    f"""WITH t AS (SELECT id, CASE WHEN id % 7 = 2 THEN 12 WHEN id % 7 > 3 THEN id % 90 + 50 ELSE 0 END AS n, id % 13 AS looks,
    round((CASE WHEN id % 5 <> 0 THEN 1 ELSE 0 END + 1 + CASE WHEN id % 4 <> 0 THEN 1 ELSE 0 END + CASE WHEN id % 7 > 1 THEN 1 ELSE 0 END + 1) / 5.0 * 0.7 + (1 + CASE WHEN id % 9 < 2 THEN 1 ELSE 0 END) / 6.0 * 0.3, 6) AS completeness,
    round(1 - CASE id % 7 WHEN 2 THEN 0.1 WHEN 3 THEN 0.1 ELSE 0 END - CASE WHEN id % 6 < 2 THEN 0.2 ELSE 0 END - CASE WHEN id % 8 = 0 THEN 0.2 ELSE 0 END, 6) AS data_quality FROM {RAWS})
  SELECT id, CASE id % 2 WHEN 0 THEN 'experienced' ELSE 'novice' END AS sponsor_experience, CASE id % 3 WHEN 0 THEN 'oncology' WHEN 1 THEN 'respiratory' ELSE 'other' END AS indication_category,
    CASE id % 3 WHEN 0 THEN 'confirmatory' WHEN 1 THEN 'early_development' ELSE 'unknown' END AS phase_category, 'simple' AS endpoint_complexity, CASE WHEN looks > 2 THEN 'complex' WHEN looks > 0 THEN 'moderate' ELSE 'simple' END AS statistical_complexity,
    concat_ws(',', CASE WHEN n < 100 THEN 'small_sample_size' END, CASE WHEN looks > 3 THEN 'multiple_interim_analyses' END) AS risk_factors, completeness::DOUBLE AS completeness, data_quality::DOUBLE AS data_quality FROM t"""
)
def qc12_card_enrichment(spark, sf_dir):
    e = cards.with_enrichment(raw(spark, sf_dir), "card", "id")
    return e.withColumns({"risk_factors": F.concat_ws(",", "risk_factors"), "completeness": F.round("completeness", 6), "data_quality": F.round("data_quality", 6)})


@query(
    f"SELECT id, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 's' || id END AS trial_id, true AS is_pivotal, 'unknown' AS drug_name, CASE WHEN id % 4 = 0 THEN 'unknown' ELSE 'tte' END AS primary_endpoint_type, "
    f"CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 = 2 THEN 12 WHEN id % 7 > 3 THEN id % 90 + 50 ELSE 0 END AS total_sample_size, CAST(CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END AS INT) AS arm_count, "
    f"CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN 1.5::DOUBLE ELSE 0.05::DOUBLE END AS alpha, id % 13 AS planned_interims, CAST(CASE id % 9 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INT) AS subgroup_count, CASE id % 9 WHEN 0 THEN 'unknown,k' ELSE '' END AS subgroup_types FROM {RAWS}"
)
def qc13_card_metadata(spark, sf_dir):
    m = cards.with_metadata(raw(spark, sf_dir), "card", "id")
    return m.withColumn("subgroup_types", F.concat_ws(",", "subgroup_types")).select("id", "trial_id", "is_pivotal", "drug_name", "primary_endpoint_type", "total_sample_size", "arm_count", "alpha", "planned_interims", "subgroup_count", "subgroup_types")
