"""Queries over listings, dictionary names, running sums and the fitted resolver, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import backtests, doc_store, evaluation, fit, gazetteer, json_trees, running, securities, trial_changes, versions
from lodestar.plans import adapters as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- listings -----------------------------------------------------------------------------------------

LOG = """SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 't' ELSE 'T' END || CAST(user_id % 700 AS VARCHAR(20)) AS ticker,
  CASE event_type WHEN 'click' THEN 'close' WHEN 'signup' THEN 'transfer' WHEN 'error' THEN 'other' ELSE 'list' END AS kind, event_id % 7 AS company_id,
  CASE event_id % 5 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSE' WHEN 2 THEN 'OTCQB' WHEN 3 THEN 'PINK' ELSE 'GREY' END AS exchange,
  CAST(ts AS DATE) + CAST(event_id % 40 AS INT) AS date, CASE WHEN event_id % 3 = 0 THEN 'suspended' END AS status FROM events"""
ALLOWED = "SELECT 'NASDAQ' AS code, TRUE AS is_allowed UNION ALL SELECT 'NYSE', TRUE UNION ALL SELECT 'OTCQB', TRUE UNION ALL SELECT 'PINK', FALSE"
TIMELINE = f"""e AS ({LOG}), ok AS (SELECT *, exchange IN ('NASDAQ', 'NYSE', 'OTCQB') AS fine FROM e),
  s AS (SELECT upper(ticker) AS ticker, date, seq, 1 AS part, TRUE AS lists, company_id, exchange, CAST(NULL AS VARCHAR) AS status FROM ok WHERE kind IN ('list', 'transfer') AND fine
    UNION ALL SELECT upper(ticker), date, seq, 0, FALSE, NULL, NULL, status FROM ok WHERE kind = 'close' OR (kind = 'transfer' AND fine)),
  d AS (SELECT ticker, date, lists, company_id, exchange, status, min(struct_pack(d := date, s := seq, p := part)) AS a FROM s GROUP BY ALL),
  n AS (SELECT l.ticker, l.company_id, l.exchange, l.date, l.a, min(x.a) FILTER (x.lists) AS nl, min(x.a) FILTER (NOT x.lists AND x.date > l.date) AS nc, arg_min(coalesce(x.status, 'delisted'), x.a) FILTER (NOT x.lists AND x.date > l.date) AS ns
    FROM d l LEFT JOIN d x ON x.ticker = l.ticker AND x.a > l.a WHERE l.lists GROUP BY ALL),
  k AS (SELECT *, nc IS NOT NULL AND (nl IS NULL OR nc < nl) AS closes FROM n),
  r AS (SELECT ticker, company_id, exchange, date AS valid_from, CASE WHEN closes THEN nc.d ELSE nl.d END AS valid_to, CASE WHEN closes THEN ns WHEN nl IS NULL THEN 'active' ELSE 'delisted' END AS status, CASE WHEN closes THEN 'closing' WHEN nl IS NOT NULL THEN 'listing' END AS closed_by FROM k)"""


def ranges(spark, sf_dir):
    judged = securities.admitted(A.select(spark, sf_dir, LOG, "events"), spark.sql(ALLOWED))
    return securities.timeline(judged.where("admitted"))


@query(f"WITH {TIMELINE} SELECT *, FALSE AS marker FROM r UNION ALL SELECT ticker, company_id, exchange, valid_to, valid_to, status, closed_by, TRUE FROM r WHERE closed_by = 'closing'")
def snk7_listing_timeline(spark, sf_dir):
    return ranges(spark, sf_dir)


@query(f"WITH {TIMELINE} SELECT ticker, company_id, exchange, valid_from, status FROM r WHERE valid_from <= DATE '2024-01-25' AND (valid_to IS NULL OR valid_to > DATE '2024-01-25')")
def snk6_listed_on(spark, sf_dir):
    return securities.listed_on(ranges(spark, sf_dir), F.lit("2024-01-25").cast("date")).select("ticker", "company_id", "exchange", "valid_from", "status")


ROWS = """SELECT c_custkey AS row_no, CASE WHEN c_custkey % 41 <> 0 THEN c_custkey % 400 END AS cik, 'Acme ' || c_mktsegment || ' ' || CAST(c_custkey % 130 AS VARCHAR(20)) || ', Inc.' AS title, 'K' || CAST(c_custkey AS VARCHAR(20)) AS ticker,
  CASE c_nationkey % 8 WHEN 0 THEN 'Nasdaq' WHEN 1 THEN ' NYSE' WHEN 2 THEN 'OTCQX U.S.' WHEN 3 THEN 'NYSE MKT' WHEN 4 THEN 'Pink' WHEN 5 THEN 'nasdaq capital market' WHEN 6 THEN 'OTCQB' END AS exchange FROM customer"""
KNOWN = "SELECT s_suppkey AS company_id, 3 * s_suppkey AS cik, s_name AS name FROM supplier"
HAVE = "SELECT s_suppkey AS company_id, 'acme furniture ' || CAST(3 * s_suppkey % 130 AS VARCHAR(20)) || ' inc' AS alias_norm, CASE WHEN s_suppkey % 4 = 0 THEN 'former' ELSE 'legal' END AS alias_type FROM supplier"
ON = "SELECT 'NASDAQ' AS code, TRUE AS is_allowed UNION ALL SELECT 'NYSE', TRUE UNION ALL SELECT 'NYSE American', TRUE UNION ALL SELECT 'OTCQX', FALSE"
REGISTRANTS = f"""x AS ({ROWS}), c AS (SELECT *, CASE WHEN lower(trim(exchange)) IN ('nasdaq', 'nasdaq capital market') THEN 'NASDAQ' WHEN lower(trim(exchange)) = 'nyse' THEN 'NYSE' WHEN lower(trim(exchange)) = 'nyse mkt' THEN 'NYSE American' WHEN lower(trim(exchange)) = 'otcqx u.s.' THEN 'OTCQX' WHEN lower(trim(exchange)) = 'otcqb' THEN 'OTCQB' END AS code FROM x WHERE cik IS NOT NULL),
  n AS (SELECT * FROM c WHERE code IS NOT NULL), t AS (SELECT cik, arg_max(title, row_no) AS title FROM n GROUP BY cik), k AS ({KNOWN}),
  f AS (SELECT (SELECT coalesce(max(company_id), 0) FROM k) + row_number() OVER (ORDER BY cik) AS company_id, cik, title AS name FROM t WHERE cik NOT IN (SELECT cik FROM k)),
  s AS (SELECT company_id, cik, coalesce(title, name) AS name FROM k LEFT JOIN t USING (cik) UNION ALL SELECT * FROM f),
  o AS (SELECT n.*, company_id, trim(regexp_replace(regexp_replace(lower(title), '[^\\w\\-]+', ' ', 'g'), '\\s+', ' ', 'g')) AS alias_norm FROM n JOIN s USING (cik))"""


def registrants(spark, sf_dir):
    rows, known, have = (A.select(spark, sf_dir, q, t) for q, t in ((ROWS, "customer"), (KNOWN, "supplier"), (HAVE, "supplier")))
    return securities.ingest_registrants(rows, known, have, spark.sql(ON), F.lit("1900-01-01").cast("date"))


@query(f"WITH {REGISTRANTS} SELECT company_id, cik, name FROM s")
def er22_registrant_companies(spark, sf_dir):
    return registrants(spark, sf_dir)["companies"]


@query(f"WITH {REGISTRANTS} SELECT company_id, alias_norm, arg_min(title, row_no) AS alias, 'legal' AS alias_type FROM o WHERE NOT EXISTS (SELECT 1 FROM ({HAVE}) h WHERE h.company_id = o.company_id AND h.alias_norm = o.alias_norm AND h.alias_type = 'legal') GROUP BY company_id, alias_norm")
def er22_registrant_aliases(spark, sf_dir):
    return registrants(spark, sf_dir)["aliases"]


@query(f"WITH {REGISTRANTS} SELECT (SELECT count(*) FROM f) AS inserted_companies, (SELECT count(*) FROM n) - (SELECT count(*) FROM f) AS updated_companies, (SELECT count(*) FROM n WHERE code IN ('NASDAQ', 'NYSE', 'NYSE American')) AS activated, (SELECT count(*) FROM x) - (SELECT count(*) FROM n WHERE code IN ('NASDAQ', 'NYSE', 'NYSE American')) AS skipped")
def er22_registrant_counts(spark, sf_dir):
    return registrants(spark, sf_dir)["counts"]


@query(f"WITH {REGISTRANTS} SELECT upper(ticker) AS ticker, company_id, code AS exchange, DATE '1900-01-01' AS valid_from, 'active' AS status FROM o WHERE code IN ('NASDAQ', 'NYSE', 'NYSE American')")
def er22_registrant_listings(spark, sf_dir):
    return securities.timeline(registrants(spark, sf_dir)["events"]).select("ticker", "company_id", "exchange", "valid_from", "status")


# --- names in texts -----------------------------------------------------------------------------------

NAMES = "SELECT DISTINCT lower(substr(text, 1, 4)) AS name, 'short' AS name_type FROM benchmark UNION SELECT DISTINCT lower(substr(text, 3, 12)), 'long' FROM benchmark"


@query(
    f"""WITH n AS (SELECT name, min(name_type) AS name_type FROM ({NAMES}) GROUP BY name), z AS (SELECT DISTINCT length(name) AS size FROM n),
  k AS (SELECT doc_id, o, substr(lower(text), CAST(o + 1 AS BIGINT), 211) AS piece, substr(text, CAST(o + 1 AS BIGINT), 211) AS whole FROM documents, LATERAL (SELECT unnest(range(0, length(text), 200)) AS o)),
  p AS (SELECT doc_id, o + j AS start, size, substr(piece, CAST(j + 1 AS BIGINT), size) AS name, substr(whole, CAST(j + 1 AS BIGINT), size) AS found FROM k, z, range(0, 200) r(j) WHERE j + size <= length(piece))
  SELECT doc_id, name, name_type, start, start + size AS "end", found FROM p JOIN n USING (name)"""
)
def tx2_dictionary_names(spark, sf_dir):
    docs = A.tables(spark, sf_dir, "documents")["documents"]
    return gazetteer.find_names(docs, A.select(spark, sf_dir, NAMES, "benchmark"), "doc_id", "text")


# --- running sums and the fitted resolver ----------------------------------------------------------------


@query("SELECT l_returnflag, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.75), 6) AS p75, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.9), 6) AS p90, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0), 6) AS least FROM lineitem GROUP BY l_returnflag")
def sg5_exact_quantiles(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"]
    found = running.exact_quantiles(line, ["l_returnflag"], F.col("l_extendedprice"), {"p75": 0.75, "p90": 0.9, "least": 0.0})
    return found.select("l_returnflag", *(F.round(c, 6).alias(c) for c in ("p75", "p90", "least")))


REVIEWED = "SELECT o_orderkey, o_custkey, (CAST(floor(o_totalprice) AS BIGINT) % 997) / 997e0 AS score, CAST(floor(o_totalprice) AS BIGINT) % 997 + o_custkey % 300 > 800 AS correct FROM orders"


@query(f"WITH s AS ({REVIEWED}), b AS (SELECT score, count(*) AS n, count(*) FILTER (correct) AS p FROM s GROUP BY score), r AS (SELECT score, sum(n) OVER (ORDER BY score DESC) AS accepted, sum(p) OVER (ORDER BY score DESC) AS hits FROM b) SELECT score AS threshold, CAST(accepted AS BIGINT) AS accepted, CAST(hits AS BIGINT) AS hits, hits / CAST(accepted AS DOUBLE) AS precision FROM r")
def er13_precision_curve(spark, sf_dir):
    return running.precision_curve(A.select(spark, sf_dir, REVIEWED, "orders"), F.col("score"), F.col("correct"))


@query(f"WITH s AS ({REVIEWED}), t AS (SELECT a.score FROM (SELECT DISTINCT score FROM s) a JOIN s b ON b.score >= a.score GROUP BY a.score HAVING count(*) FILTER (b.correct) >= 95e-2 * count(*)) SELECT greatest(5e-1, coalesce(min(score), 1e0)) AS tau_accept FROM t")
def er13_threshold(spark, sf_dir):
    curve = running.precision_curve(A.select(spark, sf_dir, REVIEWED, "orders"), F.col("score"), F.col("correct"))
    return running.threshold_for(curve)


PAIRS = "SELECT o_orderkey AS pair_id, o_custkey AS sponsor, (CAST(floor(o_totalprice) AS BIGINT) % 997) / 997e0 AS name_similarity, (o_orderkey % 7) / 7e0 AS overlap, CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 997 + 40 * (o_orderkey % 7) + o_custkey % 300 > 800 THEN 1 ELSE 0 END AS label FROM orders"


@query(None)
def er13_fit(spark, sf_dir):
    """pair_id and calibrated score of every reviewed pair, accepted from the fitted threshold on."""
    model = fit.fit_resolver(A.select(spark, sf_dir, PAIRS, "orders"), ["name_similarity", "overlap"], "label", "sponsor")
    return model.scored.select("pair_id", "score", (F.col("score") >= model.tau_accept).alias("accepted"))


# --- changes of trials -------------------------------------------------------------------------------------

#: A version in flat columns; kinds of interventions, places and collaborators are bits of whole numbers.
FLAT = """SELECT event_id AS version_id, user_id AS trial_id, ts, 'Title ' || CAST(event_id % 3 AS VARCHAR(9)) AS brief_title, CASE event_type WHEN 'click' THEN 'PHASE2' WHEN 'view' THEN 'PHASE3' END AS phase,
  CASE WHEN event_id % 4 = 0 THEN 'RECRUITING' ELSE 'COMPLETED' END AS status, 'Lead ' || CAST(user_id % 5 + event_id % 2 AS VARCHAR(9)) AS lead, CASE WHEN event_id % 6 <> 0 THEN 'RANDOMIZED' END AS allocation, 'M' || CAST(event_id % 2 AS VARCHAR(9)) AS masking,
  event_id % 8 AS mates, event_id * 7 % 16 AS drugs, event_id * 5 % 3 AS types, event_id * 3 % 8 AS places, event_id % 4 AS goals,
  CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS enrollment, CASE WHEN event_id % 5 <> 0 THEN 25e-3 * (1 + event_id % 2) END AS alpha, CASE WHEN event_id % 7 <> 0 THEN 5e-1 + (event_id % 9) / 2e1 END AS power,
  DATE '2024-01-01' + CAST(event_id % 3 AS INT) AS started, CASE WHEN event_id % 9 <> 0 THEN DATE '2025-01-01' END AS completed FROM events"""
_BITS = ("A", "B", "C", "D")


def _bits(column: str, n: int, prefix: str) -> str:
    return "array_compact(array(" + ", ".join(f"CASE WHEN {column} DIV {1 << k} % 2 = 1 THEN '{prefix}{_BITS[k]}' END" for k in range(n)) + "))"


def trial_versions(spark, sf_dir):
    flat = A.select(spark, sf_dir, FLAT, "events")
    drug = F.expr(_bits("drugs", 4, ""))
    typed = F.transform(drug, lambda n: F.struct(n.alias("name"), F.when(n == "A", "DRUG").otherwise(F.concat(F.lit("T"), F.col("types").cast("string"))).alias("type")))
    goal = lambda k: F.struct(F.lit(f"Goal {k}").alias("measure"), F.when(F.col("goals") == 3, f"{k} weeks").alias("time_frame"))
    goals = F.array_compact(F.array(*(F.when(F.col("goals") >= k, goal(k)) for k in (1, 2))))
    fields = {
        "brief_title": F.col("brief_title"), "phase": F.col("phase"), "status": F.col("status"), "lead_sponsor_name": F.col("lead"), "collaborators": F.expr(_bits("mates", 3, "Mate ")), "allocation": F.col("allocation"), "masking": F.col("masking"),
        "interventions": typed, "primary_outcomes": goals, "enrollment": F.col("enrollment"), "alpha_level": F.col("alpha").cast("double"), "power": F.col("power").cast("double"), "study_start_date": F.col("started"), "primary_completion_date": F.col("completed"), "locations": F.expr(_bits("places", 3, "Site ")),
    }
    return flat.select("version_id", "trial_id", "ts", F.struct(*(c.alias(k) for k, c in fields.items())).alias("fields"))


def _names(column: str, n: int, prefix: str) -> str:
    return f"list_filter([{', '.join(f'CASE WHEN {column} // {1 << k} % 2 = 1 THEN {chr(39)}{prefix}{_BITS[k]}{chr(39)} END' for k in range(n))}], lambda x: x IS NOT NULL)"


_SETS = {"collaborators": _names("mates", 3, "Mate "), "drug_names": _names("drugs", 4, ""), "sites": _names("places", 3, "Site ")}
_GOALS = "CASE goals WHEN 0 THEN '' WHEN 1 THEN 'Goal 1' WHEN 2 THEN 'Goal 1; Goal 2' ELSE 'Goal 1 (1 weeks); Goal 2 (2 weeks)' END"
_PAIR = f"""v AS (SELECT *, {', '.join(f'{s} AS {k}' for k, s in _SETS.items())}, {_GOALS} AS goal FROM ({FLAT}) x),
  p AS (SELECT n.version_id, n AS n, o AS o FROM (SELECT *, lag(version_id) OVER (PARTITION BY trial_id ORDER BY ts, version_id) AS prev FROM v) n JOIN v o ON o.version_id = n.prev)"""
_ONE = "SELECT version_id, '{field}' AS field, 'MODIFIED' AS change_type, CAST({o} AS VARCHAR) AS old, CAST({n} AS VARCHAR) AS new, '{level}' AS significance, {said} AS description FROM p WHERE {when}"


def _scalar(field, column, level, said):
    return _ONE.format(field=field, o=f"o.{column}", n=f"n.{column}", level=level, said=f"'{said}'", when=f"o.{column} IS DISTINCT FROM n.{column}")


def _share(column, field, level, said, otherwise):
    there = f"coalesce(o.{column}, 0) <> 0 AND coalesce(n.{column}, 0) <> 0"
    ratio = f"abs(n.{column} - o.{column}) / CAST(o.{column} AS DOUBLE)"
    when = f"o.{column} IS DISTINCT FROM n.{column} AND CASE WHEN {there} THEN {ratio} >= 1e-1 ELSE {'TRUE' if otherwise else 'FALSE'} END"
    text = f"'{said} by ' || printf('%.1f%%', 100 * {ratio})"
    return _ONE.format(field=field, o=f"o.{column}", n=f"n.{column}", level=level, said=f"CASE WHEN {there} THEN {text} ELSE 'Sample size information changed' END" if otherwise else text, when=when)


def _set(column, field, level, what):
    added = f"SELECT version_id, '{field}', 'ADDED', NULL, x, '{level}', 'New {what} added: ' || x FROM p, LATERAL (SELECT unnest(n.{column}) AS x) WHERE NOT list_contains(o.{column}, x)"
    gone = f"SELECT version_id, '{field}', 'REMOVED', x, NULL, '{level}', '{what.capitalize()} removed: ' || x FROM p, LATERAL (SELECT unnest(o.{column}) AS x) WHERE NOT list_contains(n.{column}, x)"
    return f"{added} UNION ALL {gone}"


_LISTED = "array_to_string(list_sort({0}.collaborators), ', ')"


def _mates(verb, a, b):
    names = f"list_filter({b}.collaborators, lambda x: NOT list_contains({a}.collaborators, x))"
    return _ONE.format(field="sponsor_info.collaborators", o=_LISTED.format("o"), n=_LISTED.format("n"), level="MEDIUM", said=f"'Collaborators {verb}: ' || array_to_string(list_sort({names}), ', ')", when=f"len({names}) > 0")


_TYPE = "CASE WHEN x = 'A' THEN 'DRUG' ELSE 'T' || CAST({0}.types AS VARCHAR) END"
GROUPS = " UNION ALL ".join(
    [
        _scalar("brief_title", "brief_title", "LOW", "Brief title changed"), _scalar("phase", "phase", "HIGH", "Trial phase changed"), _scalar("status", "status", "HIGH", "Trial status changed"),
        _scalar("sponsor_info.lead_sponsor_name", "lead", "MEDIUM", "Lead sponsor name changed"), _mates("added", "o", "n"), _mates("removed", "n", "o"),
        _scalar("trial_design.allocation", "allocation", "HIGH", "Trial allocation method changed"), _scalar("trial_design.masking", "masking", "HIGH", "Trial masking/blinding changed"), _set("drug_names", "interventions", "MEDIUM", "intervention"),
        f"SELECT version_id, 'interventions.' || x || '.type', 'MODIFIED', {_TYPE.format('o')}, {_TYPE.format('n')}, 'MEDIUM', 'Intervention type changed for ' || x FROM p, LATERAL (SELECT unnest(n.drug_names) AS x) WHERE list_contains(o.drug_names, x) AND x <> 'A' AND o.types <> n.types",
        _scalar("primary_endpoint_text", "goal", "HIGH", "Primary endpoint changed"), _share("enrollment", "enrollment_info.count", "MEDIUM", "Sample size changed", True), _share("power", "statistical_analysis.power", "HIGH", "Statistical power changed", False),
        _scalar("statistical_analysis.alpha_level", "alpha", "HIGH", "Alpha level changed"), _scalar("study_start_date", "started", "MEDIUM", "Study start date changed"), _scalar("primary_completion_date", "completed", "MEDIUM", "Primary completion date changed"), _set("sites", "locations", "LOW", "location"),
    ]
)


def changed(spark, sf_dir):
    pairs = versions.with_previous(trial_versions(spark, sf_dir), "trial_id", ["ts", "version_id"], ["fields"]).where("n > 1")
    return pairs.select("version_id", trial_changes.detect_changes(F.col("was_fields"), F.col("fields")).alias("changes"))


# numbers are written alike in both engines once they are rounded texts; halves of a percent are not, so those are left out
@query(f"WITH {_PAIR}, g AS ({GROUPS}) SELECT version_id, field, change_type, CASE WHEN field LIKE 'statistical%' THEN printf('%.3f', CAST(old AS DOUBLE)) ELSE old END AS old, CASE WHEN field LIKE 'statistical%' THEN printf('%.3f', CAST(new AS DOUBLE)) ELSE new END AS new, significance, regexp_replace(description, ' by [0-9.]+%$', '') AS description FROM g")
def ch8_field_groups(spark, sf_dir):
    rows = changed(spark, sf_dir).select("version_id", F.explode("changes").alias("c")).select("version_id", "c.*")
    number = lambda c: F.when(F.col("field").startswith("statistical") & F.col(c).isNotNull(), F.format_string("%.3f", F.col(c).try_cast("double"))).otherwise(F.col(c)).alias(c)
    return rows.select("version_id", "field", "change_type", number("old"), number("new"), "significance", F.regexp_replace("description", " by [0-9.]+%$", "").alias("description"))


@query(f"WITH {_PAIR}, g AS ({GROUPS}) SELECT p.version_id, count(g.version_id) AS n_changes, count(*) FILTER (g.significance = 'HIGH') AS n_high, count(*) FILTER (g.significance IN ('HIGH', 'MEDIUM')) > 0 AS significant FROM p LEFT JOIN g ON g.version_id = p.version_id GROUP BY p.version_id")
def ch8_change_counts(spark, sf_dir):
    high = F.size(F.filter("changes", lambda c: c["significance"] == "HIGH"))
    return changed(spark, sf_dir).select("version_id", F.size("changes").cast("long").alias("n_changes"), high.cast("long").alias("n_high"), trial_changes.significant(F.col("changes")).alias("significant"))


#: Nested objects whose keys come in either order, numbers that are texts, and lists.
NESTED = """SELECT event_id AS version_id, user_id AS trial_id, ts, '{"plan": ' || CASE WHEN event_id % 2 = 0 THEN '{"alpha": ' || CAST(event_id % 3 AS VARCHAR(9)) || ', "note": "n' || CAST(event_id % 2 AS VARCHAR(9)) || '"}' ELSE '{"note": "n' || CAST(event_id % 2 AS VARCHAR(9)) || '", "alpha": ' || CAST(event_id % 3 AS VARCHAR(9)) || '}' END
  || CASE WHEN event_id % 5 <> 0 THEN ', "size": ' || CASE WHEN event_id % 7 = 0 THEN '"' || CAST(event_id % 4 AS VARCHAR(9)) || '"' ELSE CAST(event_id % 4 AS VARCHAR(9)) END ELSE '' END || ', "arms": {"a": [1, {"n": ' || CAST(event_id % 2 AS VARCHAR(9)) || '}]' || CASE WHEN event_id % 3 = 0 THEN ', "b": null' ELSE '' END || '}}' AS body,
  event_id % 3 AS alpha, event_id % 2 AS note, CASE WHEN event_id % 5 <> 0 THEN CASE WHEN event_id % 7 = 0 THEN 'text' ELSE 'number' END || CAST(event_id % 4 AS VARCHAR(9)) END AS size, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 4 AS VARCHAR(9)) END AS shown, event_id % 2 + 10 * CAST(event_id % 3 = 0 AS INT) AS arms FROM events"""
_WAS = f"v AS ({NESTED}), p AS (SELECT *, {', '.join(f'lag({c}) OVER w AS was_{c}' for c in ('alpha', 'note', 'size', 'shown', 'arms'))}, row_number() OVER w AS n FROM v WINDOW w AS (PARTITION BY trial_id ORDER BY ts, version_id))"


@query(f"WITH {_WAS} SELECT version_id, 'plan' AS key, 'modified' AS type FROM p WHERE n > 1 AND (alpha <> was_alpha OR note <> was_note) UNION ALL SELECT version_id, 'size', CASE WHEN was_size IS NULL THEN 'added' WHEN size IS NULL THEN 'removed' ELSE 'modified' END FROM p WHERE n > 1 AND size IS DISTINCT FROM was_size UNION ALL SELECT version_id, 'arms', 'modified' FROM p WHERE n > 1 AND arms <> was_arms")
def ch1_nested_diff(spark, sf_dir):
    pairs = versions.with_previous(A.select(spark, sf_dir, NESTED, "events"), "trial_id", ["ts", "version_id"], ["body"]).where("n > 1")
    return pairs.select("version_id", F.explode(versions.json_diff(F.col("was_body"), F.col("body"))).alias("d")).select("version_id", "d.key", "d.type")


@query(f"WITH {_WAS} SELECT version_id, alpha <> was_alpha AS plan_material, CASE WHEN arms // 10 <> was_arms // 10 THEN 'H' WHEN arms <> was_arms THEN 'M' END AS arms_severity, CASE WHEN arms <> was_arms THEN CAST(arms // 10 - was_arms // 10 AS INT) END AS arm_count_change FROM p WHERE n > 1 AND (alpha <> was_alpha OR note <> was_note)")
def ch4_plan_and_arms(spark, sf_dir):
    pairs = versions.with_previous(A.select(spark, sf_dir, NESTED, "events"), "trial_id", ["ts", "version_id"], ["body"]).where("n > 1")
    part = lambda c, k: F.get_json_object(c, f"$.{k}")
    both = F.struct(versions.plan_change(part("was_body", "plan"), part("body", "plan")).alias("p"), versions.arms_change(part("was_body", "arms"), part("body", "arms")).alias("a"))
    # exploded, as a filter on p would have Spark work it out twice
    rows = pairs.select("version_id", F.explode(F.filter(F.array(both), lambda x: x["p"].isNotNull())).alias("x"))
    return rows.select("version_id", F.col("x.p.material").alias("plan_material"), F.col("x.a.severity").alias("arms_severity"), F.col("x.a.arm_count_change").alias("arm_count_change"))


STUDY = """SELECT o_orderkey AS id, '{"results": {"z": "first ' || o_orderstatus || '", "a": 5, "b": {"deep": ["x", {"y": "' || o_orderpriority || '"}, 7]}}, "skip": {"no": "never"}, "doc": [{"t": "second"}, "bare", [{"u": "lost"}]]'
  || CASE WHEN o_orderkey % 3 = 0 THEN ', "trial": {"n": "tail ' || CAST(o_custkey AS VARCHAR(20)) || '"}' ELSE '' END || '}' AS body, o_orderstatus, o_orderpriority, o_custkey FROM orders"""


@query(f"SELECT id, 'second ' || CASE WHEN id % 3 = 0 THEN 'tail ' || CAST(o_custkey AS VARCHAR) || ' ' ELSE '' END || 'first ' || o_orderstatus || ' x ' || o_orderpriority AS text FROM ({STUDY}) s")
def xx3_section_texts(spark, sf_dir):
    return json_trees.section_texts(A.select(spark, sf_dir, STUDY, "orders", even=True), "id", "body")


# --- fetched pages ------------------------------------------------------------------------------------------

_HTML = "'<html><body><script>x</script><p>Trial NCT' || lpad(CAST(o_custkey AS VARCHAR(20)), 8, '0') || ' of AB-' || CAST(100 + o_custkey % 50 AS VARCHAR(20)) || ' see 10.1000/x' || CAST(o_custkey AS VARCHAR(20)) || '</p><table><tr><th>Name</th><th>N</th></tr><tr><td>v ' || CAST(o_custkey % 3 AS VARCHAR(20)) || '</td></tr></table></body></html>'"
FETCHED = f"SELECT 'https://x.org/' || CAST(o_orderkey AS VARCHAR(20)) AS url, CASE WHEN o_orderkey % 17 <> 0 THEN {_HTML} END AS content, CASE WHEN o_custkey % 5 = 0 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type, 'PR' AS source_type, 'X' AS publisher, CAST(NULL AS TIMESTAMP) AS published_at, CAST(o_orderdate AS TIMESTAMP) AS fetched_at FROM orders"
_DOCS = f"d AS (SELECT sha256(content) AS doc_id, any_value(content) AS content, arg_min(url, (fetched_at, url)) AS url, any_value(content_type) AS content_type FROM ({FETCHED}) f WHERE content IS NOT NULL GROUP BY 1), h AS (SELECT *, regexp_extract(content, 'NCT[0-9]+') AS nct, regexp_extract(content, 'AB-[0-9]+') AS code FROM d WHERE content_type LIKE 'text/html%')"


def fetched(spark, sf_dir):
    return doc_store.parse(A.select(spark, sf_dir, FETCHED, "orders"))


@query(f"WITH {_DOCS} SELECT d.doc_id, url AS source_url, content_type, coalesce(length('Trial ' || nct || ' of ' || code || ' see 10.1000/x' || CAST(CAST(substr(nct, 4) AS INT) AS VARCHAR) || ' NameN v 0'), 0) AS char_count FROM d LEFT JOIN h USING (doc_id)".replace("SELECT d.doc_id, url", "SELECT d.doc_id, d.url").replace(", content_type, coalesce", ", d.content_type, coalesce"))
def xx11_stored_pages(spark, sf_dir):
    t = fetched(spark, sf_dir)
    return t["documents"].select("doc_id", "source_url", "content_type").join(t["pages"].select("doc_id", F.col("char_count").cast("long").alias("char_count")), "doc_id")


@query(f"WITH {_DOCS} SELECT doc_id, 'nct' AS ent_type, nct AS value_norm, 6 AS char_start, 17 AS char_end FROM h UNION ALL SELECT doc_id, 'code', code, 21, 27 FROM h")
def xx11_stored_entities(spark, sf_dir):
    return fetched(spark, sf_dir)["entities"].select("doc_id", "ent_type", "value_norm", "char_start", "char_end")


@query(f"""WITH {_DOCS} SELECT h.doc_id, 0 AS table_idx, '[["Name","N"],["v ' || CAST(CAST(substr(nct, 4) AS INT) % 3 AS VARCHAR) || '"]]' AS table_jsonb, '10.1000/x' || CAST(CAST(substr(nct, 4) AS INT) AS VARCHAR) AS doi FROM h""")
def xx11_tables_and_citations(spark, sf_dir):
    t = fetched(spark, sf_dir)
    return t["tables"].select("doc_id", "table_idx", "table_jsonb").join(t["citations"].select("doc_id", "doi"), "doc_id")


@query(f"WITH {_DOCS} SELECT doc_id, nct AS nct_id, code AS asset, 'nct_near_asset' AS link_type, 1e0 AS confidence FROM h UNION ALL SELECT doc_id, NULL, code, 'code_in_text', 9e-1 FROM h")
def xx10_document_links(spark, sf_dir):
    return fetched(spark, sf_dir)["links"]


# --- backtests and backfill -------------------------------------------------------------------------------------

RANKED = "SELECT user_id AS trial_id, ts AS captured_at, event_id, CAST(floor(value * 100) AS BIGINT) % 100 / 1e2 AS p_fail FROM events WHERE event_id % 3 = 0"
OUTCOMES = "SELECT DISTINCT user_id AS trial_id, user_id % 4 = 0 AS success FROM events WHERE user_id % 5 <> 0"
_STATES = f"k AS ({RANKED}), days AS (SELECT CAST(DATE '2024-01-03' + CAST(7 * i AS INT) AS DATE) AS snapshot_date FROM range(0, 5) r(i)), st AS (SELECT snapshot_date, trial_id, arg_max(struct_pack(e := event_id, p := p_fail), struct_pack(c := captured_at, e := event_id, p := p_fail)) AS r FROM days JOIN k ON CAST(captured_at AS DATE) <= snapshot_date GROUP BY 1, 2)"


def states(spark, sf_dir):
    day = lambda d: F.lit(d).cast("date")
    return backtests.snapshots(A.select(spark, sf_dir, RANKED, "events"), day("2024-01-03"), day("2024-02-05"), 7)


@query(f"WITH {_STATES} SELECT snapshot_date, trial_id, r.e AS event_id, r.p AS p_fail FROM st")
def bt1_snapshots(spark, sf_dir):
    return states(spark, sf_dir).select("snapshot_date", "trial_id", "event_id", "p_fail")


@query(
    f"""WITH {_STATES}, o AS ({OUTCOMES}), j AS (SELECT snapshot_date, NOT coalesce(success, FALSE) AS failed, row_number() OVER (PARTITION BY snapshot_date ORDER BY r.p DESC, trial_id) AS rank FROM st LEFT JOIN o USING (trial_id)),
  m AS (SELECT snapshot_date, k, count(*) AS n, count(*) FILTER (failed) AS f, count(*) FILTER (failed AND rank <= k) AS h FROM j, (VALUES (1), (3), (5), (10)) v(k) GROUP BY 1, 2)
  SELECT snapshot_date, k, round(h / CAST(k AS DOUBLE), 9) AS precision, round(coalesce(h / nullif(CAST(f AS DOUBLE), 0), 0), 9) AS recall, round(coalesce(2e0 * h / nullif(k + f, 0), 0), 9) AS f1 FROM m WHERE k <= n"""
)
def bt1_precision_by_day(spark, sf_dir):
    found = backtests.precision_by_day(states(spark, sf_dir), A.select(spark, sf_dir, OUTCOMES, "events"), F.col("p_fail"))
    return found.select("snapshot_date", "k", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


RUNS = "SELECT 'p' || CAST(user_id % 60 AS VARCHAR(9)) AS pipeline_name, CAST(ts AS DATE) AS day, event_type <> 'error' AS success, ts AS start_time FROM events WHERE event_id % 5 = 0"


@query(
    f"""WITH r AS ({RUNS}), c AS (SELECT p.pipeline_name, CAST(DATE '2024-01-02' + CAST(i AS INT) AS DATE) AS day FROM (SELECT DISTINCT pipeline_name FROM r) p, range(0, 30) x(i)),
  m AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM r WHERE success AND r.pipeline_name = c.pipeline_name AND r.day = c.day)), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY pipeline_name ORDER BY day) AS INT) AS island FROM m)
  SELECT pipeline_name, min(day) AS first_day, max(day) AS last_day, CAST(count(*) AS INT) AS days FROM g GROUP BY pipeline_name, island"""
)
def or1_missing_days(spark, sf_dir):
    day = lambda d: F.lit(d).cast("date")
    return backtests.missing_days(A.select(spark, sf_dir, RUNS, "events"), day("2024-01-02"), day("2024-01-31"))


NEEDS = "SELECT DISTINCT 'p' || CAST(user_id % 60 AS VARCHAR(9)) AS pipeline_name, CASE WHEN user_id % 7 <> 0 THEN 'p' || CAST(user_id * 3 % 65 AS VARCHAR(9)) END AS needed FROM events"


@query(f"WITH n AS ({NEEDS}), l AS (SELECT pipeline_name AS needed, max(start_time) AS last FROM ({RUNS}) r WHERE success GROUP BY 1), j AS (SELECT n.pipeline_name, n.needed, n.needed IS NULL OR coalesce(last >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR, FALSE) AS ok FROM n LEFT JOIN l USING (needed)) SELECT pipeline_name, bool_and(ok) AS ready, coalesce(string_agg(needed, ',' ORDER BY needed) FILTER (NOT ok), '') AS waits_for FROM j GROUP BY 1")
def or1_ready(spark, sf_dir):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    found = backtests.ready(A.select(spark, sf_dir, RUNS, "events"), A.select(spark, sf_dir, NEEDS, "events"), now)
    return found.select("pipeline_name", "ready", F.array_join("waits_for", ",").alias("waits_for"))


# --- rankings -----------------------------------------------------------------------------------------------------

CARDS = "SELECT l_orderkey AS study_id, l_linenumber AS line, CAST(floor(l_extendedprice) AS BIGINT) AS trial_id, CASE WHEN l_orderkey % 97 = 5 THEN 100 + l_orderkey ELSE l_partkey % 10 + 1 END AS base_rank, CAST(floor(l_extendedprice) AS BIGINT) % 101 AS percent FROM lineitem"
_CARDS = f"SELECT study_id, trial_id, min(base_rank) AS base_rank, min(percent) AS percent FROM ({CARDS}) x GROUP BY 1, 2"
JUDGED = f"SELECT study_id, trial_id, (study_id * 7 + trial_id) % 100 + 1 AS enhanced, 8e-1 AS confidence FROM ({_CARDS}) y WHERE study_id % 3 = 0"


@query(
    f"""WITH c AS ({_CARDS}), j AS ({JUDGED}), n AS (SELECT base_rank FROM c GROUP BY 1 HAVING count(*) > 1),
  s AS (SELECT study_id, trial_id, base_rank, CAST(coalesce(enhanced, CASE WHEN base_rank <= 3 THEN trunc(1 + percent * 30 / 100) WHEN base_rank <= 6 THEN trunc(31 + percent * 30 / 100) ELSE trunc(61 + percent * 39 / 100) END) AS INT) AS enhanced, CASE WHEN enhanced IS NULL THEN 5e-1 ELSE CAST(confidence AS DOUBLE) END AS confidence FROM c JOIN n USING (base_rank) LEFT JOIN j USING (study_id, trial_id))
  SELECT *, row_number() OVER (PARTITION BY base_rank ORDER BY enhanced DESC, study_id, trial_id) AS relative_position FROM s"""
)
def xx8_resolved_positions(spark, sf_dir):
    cards = A.select(spark, sf_dir, _CARDS, "lineitem").withColumn("quality", F.col("percent").cast("decimal(10,2)") / F.lit(100).cast("decimal(10,2)"))
    return evaluation.resolved_positions(cards, A.select(spark, sf_dir, JUDGED, "lineitem"))
