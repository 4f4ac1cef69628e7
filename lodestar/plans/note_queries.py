"""Queries over notes on texts, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import notes
from lodestar.plans import adapters as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
EVERY = 1_000_000  # reports show the first few; a query returns all


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


TEXTS = """SELECT o_orderkey AS id, 'Open  label study ' || CAST(o_orderkey AS VARCHAR(20)) || ' of n < ' || CAST(o_orderkey % 90 AS VARCHAR(20))
  || CASE o_orderkey % 3 WHEN 0 THEN ', small sample; severe dropout and bias' WHEN 1 THEN '. Missing data, post hoc, a date mismatch of enrollment and completion' ELSE ', limited generalizability' END
  || CASE o_orderkey % 5 WHEN 0 THEN '. Registry mismatch with publication (Japan, JAPAN, japan, Japan)' WHEN 1 THEN '. Protocol Amendment, primary vs secondary; p < 0.0010 and p <0.001 in USA' ELSE '' END
  || CASE o_orderkey % 4 WHEN 0 THEN '. Table 2: Baseline results. See Fig. 3B, Figure 4. Kaplan curves of patients' WHEN 1 THEN '. Grants of Acme Health Company and NIH12345 support, consulting fees' ELSE '. Tab 7, table 1A' END
  || CASE o_orderkey % 7 WHEN 0 THEN ' "we conclude that it works, thus good"' WHEN 1 THEN ' ''a caveat within these words'' Impact factor: 12.5, BMJ, open access, PMID: 77' WHEN 2 THEN ' "over 24 months of it all" preprint, paywall, Journal of x, IF = 3' ELSE ' peer review, poster' END AS t FROM orders"""


def texts(spark, sf_dir):
    return A.select(spark, sf_dir, TEXTS, "orders", even=True)


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def found(patterns: dict[str, tuple[str, ...]], options: str = "i") -> str:
    """SQL for all matches: (id, t, kind, pat, value, s, e), offsets from the text between matches."""
    rows = ", ".join(f"({quoted(k)}, {quoted(p)})" for k, ps in patterns.items() for p in ps)
    return f"""(WITH d AS ({TEXTS}), p(kind, pat) AS (VALUES {rows}),
      m AS (SELECT id, t, kind, pat, regexp_extract_all(t, pat, 0, '{options}') AS v, regexp_split_to_array(t, pat, '{options}') AS b FROM d, p),
      u AS (SELECT id, t, kind, pat, v[i] AS value, length(array_to_string(b[1:i], '')) + length(array_to_string(v[1:i-1], '')) AS s FROM m, unnest(range(1, len(v) + 1)) AS r(i))
      SELECT id, t, kind, pat, value, CAST(s AS INT) AS s, CAST(s + length(value) AS INT) AS e FROM u)"""


def context(reach: int) -> str:
    return f"lower(t[greatest(s - {reach}, 0) + 1 : e + {reach}])"


SEVERITY = f"""CASE WHEN regexp_matches(lower(value), 'terminated|stopped|failed') OR regexp_matches({context(100)}, 'critical|severe|major|significant') THEN 'critical'
  WHEN regexp_matches(lower(value), 'underpowered|small sample|insufficient') OR kind IN ('sample_size', 'follow_up') THEN 'major'
  WHEN regexp_matches(lower(value), 'limited|restricted|narrow') OR kind IN ('endpoints', 'analysis') THEN 'moderate' ELSE 'minor' END"""


@query(f"SELECT id, kind AS type, value AS description, {SEVERITY} AS severity, s AS start, e AS stop, trim(t[greatest(s - 100, 0) + 1 : e + 100]) AS preview FROM {found(notes.LIMITATIONS)}")
def tx27_limitations(spark, sf_dir):
    rows = texts(spark, sf_dir).select("id", F.explode(notes.limitations(F.col("t"), most=EVERY)).alias("m"))
    return rows.select("id", "m.type", "m.description", "m.severity", "m.start", F.col("m.end").alias("stop"), "m.preview")


@query(f"SELECT id, kind AS type, value AS description, s AS start, e AS stop FROM {found(notes.ODDITIES)}")
def tx27_oddities(spark, sf_dir):
    rows = texts(spark, sf_dir).select("id", F.explode(notes.oddities(F.col("t"), most=EVERY)).alias("m"))
    return rows.select("id", "m.type", "m.description", "m.start", F.col("m.end").alias("stop"))


def _both(*words: str) -> str:
    return " AND ".join(f"contains(c, '{w}')" for w in words)


@query(
    f"SELECT id, kind AS type, value AS description, s AS start, CASE kind WHEN 'numbers' THEN CASE WHEN {_both('registry', 'publication')} THEN 'Registry' WHEN {_both('trial', 'paper')} THEN 'Trial data' ELSE 'Source 1' END "
    f"WHEN 'dates' THEN CASE WHEN {_both('protocol', 'amendment')} THEN 'Original protocol' WHEN {_both('enrollment', 'completion')} THEN 'Enrollment date' ELSE 'Date 1' END "
    f"WHEN 'demographics' THEN CASE WHEN {_both('itt', 'pp')} THEN 'ITT population' ELSE 'Population 1' END ELSE CASE WHEN {_both('primary', 'secondary')} THEN 'Primary endpoint' ELSE 'Outcome 1' END END AS source1 "
    f"FROM (SELECT *, {context(150)} AS c FROM {found(notes.DISCREPANCIES)})"
)
def tx29_discrepancy_sources(spark, sf_dir):
    rows = texts(spark, sf_dir).select("id", F.explode(notes.discrepancies(F.col("t"), most=EVERY)).alias("m"))
    return rows.select("id", "m.type", "m.description", "m.start", "m.source1")


@query(
    f"SELECT id, value AS region, s AS start, CASE WHEN regexp_matches({context(150)}, 'significant|major|important|key') THEN 'significant' WHEN regexp_matches({context(150)}, 'moderate|some|partial') THEN 'moderate' ELSE 'minimal' END AS impact "
    f"FROM {found({'region': notes.REGIONS})} WHERE len(regexp_extract_all(t, value, 0, 'i')) > 3"
)
def tx27_region_outliers(spark, sf_dir):
    rows = texts(spark, sf_dir).select("id", F.explode(notes.region_outliers(F.col("t"), most=EVERY)).alias("m"))
    return rows.select("id", "m.region", "m.start", "m.impact")


@query(
    f"SELECT id, 'conflict' AS note, kind AS type, value AS said, CAST(NULL AS VARCHAR) AS grant_number, s AS start FROM {found(notes.CONFLICTS)} UNION ALL "
    f"SELECT id, 'funding', kind, coalesce(nullif(regexp_extract(value, '\\b[A-Z][a-z]+(?:\\s+[A-Z][a-z]+)*\\b'), ''), 'Unknown'), nullif(regexp_extract(value, '\\b[A-Z]{{2,4}}\\d{{4,6}}\\b'), ''), s FROM {found(notes.FUNDING)}"
)
def tx24_conflicts_funding(spark, sf_dir):
    base = texts(spark, sf_dir)
    c = base.select("id", F.explode(notes.conflicts(F.col("t"))).alias("m")).select("id", F.lit("conflict").alias("note"), "m.type", F.col("m.description").alias("said"), F.lit(None).cast("string").alias("grant_number"), "m.start")
    f = base.select("id", F.explode(notes.funding(F.col("t"))).alias("m")).select("id", F.lit("funding").alias("note"), "m.type", F.col("m.entity").alias("said"), "m.grant_number", "m.start")
    return c.unionAll(f)


def _any(patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches(t, {quoted(p)}, 'i')" for p in patterns) + ")"


@query(
    f"SELECT id, CASE WHEN {_any(notes.JOURNALS['high_impact'])} THEN 'high_impact' WHEN {_any(notes.JOURNALS['specialty'])} THEN 'specialty' WHEN {_any(notes.JOURNALS['conference'])} THEN 'conference' ELSE 'general' END AS journal_type, "
    f"CASE id % 7 WHEN 1 THEN 12.5::DOUBLE WHEN 2 THEN 3::DOUBLE END AS impact_factor, CASE id % 7 WHEN 1 THEN true WHEN 2 THEN false END AS open_access, CASE WHEN id % 7 > 2 THEN true WHEN id % 7 = 2 THEN false END AS peer_reviewed, "
    f"'10.' || id AS doi, CASE WHEN id % 7 = 1 THEN '77' END AS pmid, '2020' AS publication_date, round(least(1, 0.7 + CASE WHEN id % 7 IN (1, 2) THEN 0.3 ELSE 0 END), 6)::DOUBLE AS confidence FROM ({TEXTS})"
)
def tx24_publication(spark, sf_dir):
    key = F.col("id").cast("string")
    p = notes.publication(F.col("t"), F.concat(F.lit("https://doi.org/10."), key, F.lit("/z")), key, F.lit(2020))
    return texts(spark, sf_dir).select("id", p.alias("p")).select("id", "p.journal_type", "p.impact_factor", "p.open_access", "p.peer_reviewed", "p.doi", "p.pmid", "p.publication_date", F.round("p.confidence", 6).alias("confidence"))


def _captions(patterns: tuple[str, ...], word: str) -> str:
    return f"(SELECT id, s, regexp_extract(value, pat, 1, 'i') AS label, CASE WHEN kind = '1' THEN regexp_extract(value, pat, 2, 'i') ELSE '{word} ' || regexp_extract(value, pat, 1, 'i') END AS caption FROM {found({str(i): (p,) for i, p in enumerate(patterns)})})"


def _listed(kinds: dict[str, tuple[str, ...]]) -> str:
    each = " || ".join(f"CASE WHEN regexp_matches(lower(caption), '{'|'.join(words)}') THEN ',{k}' ELSE '' END" for k, words in kinds.items())
    return f"coalesce(nullif(ltrim({each}, ','), ''), 'other')"


def _kind(kinds: dict[str, tuple[str, ...]], c: str, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({c}), '{'|'.join(words)}') THEN '{k}'" for k, words in kinds.items()) + f" ELSE '{otherwise}' END"


@query(
    f"SELECT id, 'table' AS what, label, caption, CAST(NULL AS VARCHAR) AS figure_type, {_listed(notes.TABLE_DATA)} AS data_types, s AS start FROM {_captions(notes.TABLES, 'Table')} UNION ALL "
    f"SELECT id, 'figure', label, caption, {_kind(notes.FIGURE_KINDS, 'caption', 'other')}, {_listed(notes.FIGURE_DATA)}, s FROM {_captions(notes.FIGURES, 'Figure')}"
)
def tx26_tables_figures(spark, sf_dir):
    base = texts(spark, sf_dir)
    t = base.select("id", F.explode(notes.table_references(F.col("t"))).alias("m")).select("id", F.lit("table").alias("what"), "m.label", "m.caption", F.lit(None).cast("string").alias("figure_type"), F.concat_ws(",", "m.data_types").alias("data_types"), "m.start")
    f = base.select("id", F.explode(notes.figure_references(F.col("t"))).alias("m")).select("id", F.lit("figure").alias("what"), "m.label", "m.caption", "m.figure_type", F.concat_ws(",", "m.data_types").alias("data_types"), "m.start")
    return t.unionAll(f)


@query(
    f"SELECT id, said AS text, CASE WHEN regexp_matches(said, '\\d') THEN 'numeric' ELSE {_kind(notes.QUOTE_KINDS, 'said', 'qualitative')} END AS data_type, s AS start, e AS stop, trim(t[greatest(s - 100, 0) + 1 : e + 100]) AS context "
    f"FROM (SELECT *, regexp_extract(value, pat, 1) AS said FROM {found({'quote': notes.QUOTES}, 'c')})"
)
def tx26_quotes(spark, sf_dir):
    rows = texts(spark, sf_dir).select("id", F.explode(notes.quotes(F.col("t"), most=EVERY)).alias("m"))
    return rows.select("id", "m.text", "m.data_type", "m.start", F.col("m.end").alias("stop"), "m.context")


STUDY = """'{"sample_size":{"total_n":' || CAST(o_orderkey % 200 AS VARCHAR(20)) || ',"power":0.' || CAST(5 + o_orderkey % 5 AS VARCHAR(20)) || '},"trial":{"status":"' || CASE o_orderkey % 3 WHEN 0 THEN 'Terminated' ELSE 'Active' END
  || '"},"primary_endpoints":[' || CASE o_orderkey % 2 WHEN 0 THEN '1,2,3,4' ELSE '1' END || '],"results":{"primary":[{"p_value":0.0' || CAST(o_orderkey % 4 AS VARCHAR(20)) || '},{"p_value":"none"}]},"populations":{"dropouts_overall_pct":' || CAST(o_orderkey % 40 AS VARCHAR(20))
  || ',"analysis_primary_on":"' || CASE o_orderkey % 5 WHEN 0 THEN 'ITT' ELSE 'PP' END || '"},"protocol_changes":[{"post_LPR":' || CASE o_orderkey % 7 WHEN 0 THEN 'true' ELSE 'false' END || ',"change":"dose"},{}]}'"""


@query(
    "WITH x AS (SELECT o_orderkey AS id, unnest(list_filter(["
    "CASE WHEN o_orderkey % 200 BETWEEN 1 AND 99 THEN 'limitation sample_size Small sample size (n=' || (o_orderkey % 200) || ')' END, CASE WHEN o_orderkey % 5 < 3 THEN 'limitation sample_size Underpowered study (power=0.' || (5 + o_orderkey % 5) || '0)' END, "
    "CASE WHEN o_orderkey % 3 = 0 THEN 'limitation follow_up Study terminated early' END, CASE WHEN o_orderkey % 2 = 0 THEN 'limitation endpoints Multiple primary endpoints may reduce statistical power' END, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'oddity statistical Extremely low p-value (p=0.000000)' END, CASE WHEN o_orderkey % 40 > 20 THEN 'oddity clinical High dropout rate (' || (o_orderkey % 40) || '%)' END, "
    "CASE WHEN o_orderkey % 5 <> 0 THEN 'discrepancy outcomes Primary analysis not on ITT population' END, CASE WHEN o_orderkey % 7 = 0 THEN 'discrepancy dates Protocol change after LPR' END], lambda v: v IS NOT NULL)) AS note FROM orders) SELECT id, note FROM x"
)
def tx28_structure(spark, sf_dir):
    card = F.parse_json("card")
    said = lambda what, c: F.transform(c, lambda m: F.concat_ws(" ", F.lit(what), m["type"], m["description"]))
    every = F.concat(said("limitation", notes.structural_limitations(F.col("card"))), said("oddity", notes.structural_oddities(F.col("card"))), said("discrepancy", notes.structural_discrepancies(F.col("card"))))
    cards = A.tables(spark, sf_dir, "orders")["orders"].selectExpr("o_orderkey AS id", f"{STUDY} AS card")
    return cards.withColumn("card", card).select("id", F.explode(every).alias("note"))
