"""Filing events, JSON study cards and queues: projections over one row, and joins on keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions.dates import congress_window, text_window
from lodestar.operators.resolve import not_ignored

# Event types that call for an evaluation of signals; those that need a trial's identifier.
HIGH_IMPACT = ("endpoint_met", "endpoint_missed", "safety_signal", "program_discontinuation", "regulatory_hold")
NEEDS_TRIAL = ("endpoint_met", "safety_signal")
REVIEW_REASON = "Low confidence or validation issues"
# Names of risk factors in notes, and the lines that open a level.
RISK_NAMES = ("protocol_change_post_lpr", "underpowered_study", "subgroup_only_win", "pp_analysis_instead_itt", "effect_size_anomaly", "missing_evidence", "inconsistent_data", "low_coverage_quality", "endpoint_changes", "population_issues")
RISK_LEVELS = (("high", "High-risk factors:"), ("medium", "Medium-risk factors:"), ("low", "Low-risk factors:"))
# Endings that names in texts lose.
NAME_TAILS = (
    "inc", "inc.", "incorporated", "corp", "corp.", "corporation", "co", "co.", "company", "ltd", "ltd.", "limited", "plc", "nv", "ag", "sa", "s.a.", "bv", "holdings", "group",
    "therapeutics", "pharmaceuticals", "biosciences", "biopharma", "bioscience", "biotech", "sciences", "pharma", "bio",
)
# Forms of filings that list subsidiaries.
ANNUAL_FORMS = ("10-K", "20-F")
# Text fields of a card that are lower-cased, flags, and words that are true.
CARD_TEXTS = ("study_id", "indication", "phase", "sponsor", "drug_name", "primary_type")
CARD_FLAGS = ("is_pivotal", "single_arm")
TRUE_WORDS = ("true", "1", "yes", "on")
# Congresses that a card's readout may name, with the year.
CONGRESS = r"(?i)\b(ESMO|ASCO|ASH|AACR|ASCO-GI|ASCO-BC|ESMO-IO)\s+(20\d{2})\b"
# Limits of the business rules.
ENROLLMENT_RANGE, DURATION_RANGE = (10, 100_000), (30, 3_650)
PHASE_ORDER = ("PHASE1", "PHASE2", "PHASE3", "PHASE4")


def _step(at: Column, key: str) -> Column:
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(at, f"$['{quoted}']", "variant")


def _text(found: Column) -> Column:
    """A variant as text; objects and arrays as JSON; JSON's null is null."""
    return F.try_variant_get(found, "$", "string")


def value_at(card: Column, path: str) -> Column:
    """Text at a dotted path of a variant; `*` is the first element of an array; null if any step is missing or null."""
    steps = path.split(".") if path else None
    if steps is None:
        return F.lit(None).cast("string")
    return _text(reduce(lambda at, k: F.try_variant_get(at, "$[0]", "variant") if k == "*" else _step(at, k), steps, card))


def value_by_index(card: Column, path: str) -> Column:
    """As value_at, but digits are a place in an array (or a key of an object) and `*` is a key like any other."""
    if not path:
        return F.lit(None).cast("string")

    def step(at: Column, k: str) -> Column:
        return F.coalesce(F.try_variant_get(at, f"$[{int(k)}]", "variant"), _step(at, k)) if k.isdigit() else _step(at, k)

    return _text(reduce(step, path.split("."), card))


def has_key(card: Column, path: str) -> Column:
    """Whether all keys of a dotted path are there; a null value counts."""
    return reduce(_step, path.split("."), card).isNotNull()


def array_length(card: Column, path: str) -> Column:
    """Length of the array at a dotted path; 0 if it's missing or none."""
    return F.coalesce(F.size(F.try_variant_get(reduce(_step, path.split("."), card), "$", "array<variant>")), F.lit(0))


def card_view(studies: DataFrame) -> DataFrame:
    """Fields of the variants of studies that reports read, and five array lengths; studies without a card go."""
    at = lambda c, path: value_at(F.col(c), path)
    n = lambda c, path: array_length(F.col(c), path)
    return studies.where("extracted_jsonb is not null").select(
        "study_id", "trial_id",
        at("tone_analysis", "overall_tone").alias("overall_tone"), at("publication_details", "journal_type").alias("journal_type"), at("publication_details", "open_access").alias("open_access"),
        at("reviewer_notes", "quality_assessment.overall_quality").alias("reviewer_quality_rating"), at("reviewer_notes", "quality_assessment.evidence_strength").alias("evidence_strength"),
        n("conflicts_and_funding", "conflicts_of_interest").alias("conflicts_count"), n("conflicts_and_funding", "funding_sources").alias("funding_sources_count"),
        n("reviewer_notes", "limitations").alias("limitations_count"), n("reviewer_notes", "oddities").alias("oddities_count"), n("data_location_mapping", "quote_spans").alias("quote_spans_count"),
    )


def _number(found: Column) -> Column:
    return F.trim(_text(found)).try_cast("double")


def _clamped(found: Column, low: float, high: float, otherwise: Column) -> Column:
    """A number within limits, `otherwise` if it's none; null if the field isn't there."""
    x = _number(found)
    fit = F.when(x.isNull() | F.isnan(x), otherwise).otherwise(F.least(F.greatest(x, F.lit(low)), F.lit(high)))
    return F.when(found.isNotNull(), fit)


def _whole(found: Column, otherwise: Column) -> Column:
    x = _number(found)
    return F.when(found.isNotNull(), F.when(x.isNull() | F.isnan(x), otherwise).otherwise(x.cast("long")))


def _flag(found: Column) -> Column:
    """Words of truth for texts, not 0 for whole numbers; other kinds stay what they are, or null."""
    kind, text = F.schema_of_variant(found), _text(found)
    return F.when(kind == "STRING", F.lower(text).isin(*TRUE_WORDS)).when(kind == "BIGINT", text != "0").when(kind == "BOOLEAN", text == "true")


def normalised_card(card: Column) -> Column:
    """Struct of a card's normalised fields: texts trimmed and in lower case, flags as booleans, numbers within their
    limits.  A field that isn't there is null; one that is there but no number takes its default."""
    at = lambda path: reduce(_step, path.split("."), card)
    none_d, none_l = F.lit(None).cast("double"), F.lit(None).cast("long")
    part = lambda v, k: F.try_variant_get(v, f"$.{k}", "variant")
    arm = lambda _, v: F.struct(_whole(part(v, "n"), none_l).alias("n"), _clamped(part(v, "dropout"), 0.0, 1.0, F.lit(0.0)).alias("dropout"))
    result = lambda _, v: F.struct(_clamped(part(v, "p"), 0.0, 1.0, none_d).alias("p"), _number(part(v, "estimate")).alias("estimate"))
    children = lambda path: F.try_variant_get(at(path), "$", "map<string,variant>")
    return F.struct(
        *(F.lower(F.trim(value_at(card, c))).alias(c) for c in CARD_TEXTS),
        *(_flag(at(c)).alias(c) for c in CARD_FLAGS),
        _whole(at("sample_size"), none_l).alias("sample_size"),
        F.transform_values(children("arms"), arm).alias("arms"),
        _clamped(at("analysis_plan.alpha"), 0.001, 0.999, F.lit(0.05)).alias("alpha"),
        F.greatest(_whole(at("analysis_plan.planned_interims"), F.lit(0).cast("long")), F.when(has_key(card, "analysis_plan.planned_interims"), 0)).alias("planned_interims"),
        F.transform_values(children("primary_result"), result).alias("primary_result"),
    )


def hints(card: Column) -> Column:
    """Readout hints of a card, in order: its expected date, its congress, the first window its quoted text names.
    Structs (kind, start, end, weight, raw_text)."""
    said, name, year, quoted = (value_at(card, p) for p in ("readout.expected_date", "readout.conference.name", "readout.conference.year", "quoted_text"))
    day = F.when(said.rlike(r"^\d{4}-\d{2}-\d{2}$"), said.try_cast("date"))
    raw = F.concat(F.lit("results at "), name, F.lit(" "), year)
    known, in_year = F.regexp_extract(raw, CONGRESS, 1), F.regexp_extract(raw, CONGRESS, 2).try_cast("int")
    meeting, window = congress_window(known, in_year), text_window(quoted)
    hint = lambda kind, start, end, weight, raw: F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), weight.alias("weight"), raw.alias("raw_text"))
    return F.array_compact(
        F.array(
            F.when(day.isNotNull(), hint("exact_date", F.date_sub(day, 1), F.date_add(day, 2), F.lit(0.95), F.concat(F.lit("Expected date: "), said))),
            F.when(in_year.isNotNull(), hint("conference", meeting["start"], meeting["end"], meeting["weight"], raw)),
            F.when(window["start"].isNotNull(), hint("freeform", window["start"], window["end"], window["weight"], quoted)),
        )
    )


def needs_review(confidence: Column, flagged: Column, event_type: Column, trial: Column, least: float = 0.7) -> Column:
    """Low confidence (none counts as 0), flagged, or an event that needs a trial's identifier and has none."""
    lost = F.coalesce(event_type.isin(*NEEDS_TRIAL), F.lit(False)) & (F.coalesce(trial, F.lit("")) == "")
    return (F.coalesce(confidence, F.lit(0.0)) < least) | F.coalesce(flagged, F.lit(False)) | lost


def triggers_signals(event_type: Column, safety: Column, outcome: Column) -> Column:
    """An event of high impact, with safety events, or with the outcome of an endpoint."""
    return F.coalesce(event_type.isin(*HIGH_IMPACT), F.lit(False)) | (F.coalesce(F.size(safety), F.lit(0)) > 0) | (F.coalesce(outcome, F.lit("")) != "")


def trial_events(items: DataFrame, least: float = 0.7) -> DataFrame:
    """Extracted items of current reports as events, with their review and trigger flags."""
    first = lambda c: F.get(F.col(c), 0)
    e = items.withColumns({"event_type": F.coalesce(first("trial_events"), F.lit("unknown")), "event_description": F.coalesce(first("trial_events"), F.lit("")), "primary_endpoint_outcome": first("endpoints_mentioned")})
    c = F.col
    flags = (needs_review(c("confidence"), c("requires_review"), c("event_type"), c("trial_identifier"), least), triggers_signals(c("event_type"), c("safety_signals"), c("primary_endpoint_outcome")))
    return e.select("filing_id", "item", "event_type", "event_description", "trial_identifier", "primary_endpoint_outcome", c("safety_signals").alias("safety_events"), "confidence", flags[0].alias("needs_review"), flags[1].alias("triggers_signals"))


def clinical_updates(sections: DataFrame, least: float = 0.7) -> DataFrame:
    """Extracted sections of annual reports as development updates, with their review flag."""
    none = F.lit(None).cast("string")
    review = needs_review(F.col("confidence"), F.col("requires_review"), none, none, least)
    return sections.select("filing_id", "item", F.get("clinical_development", F.lit(0)).alias("pipeline_stage"), F.col("regulatory_updates").alias("regulatory_milestones"), "confidence", review.alias("needs_review"))


def review_items(events: DataFrame, updates: DataFrame) -> DataFrame:
    """One item for each event or update to review; its id is type, filing and place in the filing, so that no
    counter has to pass through all rows."""

    def of(rows: DataFrame, kind: str) -> DataFrame:
        item_id = F.concat_ws("_", F.lit(kind), F.col("filing_id").cast("string"), F.col("item").cast("string"))
        return rows.where("needs_review").select(item_id.alias("item_id"), "filing_id", F.lit(kind).alias("item_type"), F.lit(REVIEW_REASON).alias("reason"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))

    return of(events, "trial_event").unionAll(of(updates, "clinical_update"))


def unlinked_trials(trials: DataFrame, ignore: DataFrame, limit: int = 25) -> DataFrame:
    """The first trials by number that have a sponsor but no company, and that no ignore pattern matches."""
    open_ = trials.where("sponsor_text is not null and coalesce(sponsor_company_id, 0) = 0").select("nct_id", F.col("sponsor_text").alias("sponsor"))
    return not_ignored(open_, ignore).orderBy("nct_id").limit(limit).select("nct_id", F.col("sponsor").alias("sponsor_text"))


def first_pattern(text: Column, rules: list[tuple[str, object]]) -> Column:
    """Value of the first pattern found in a text, ignoring case; null for none."""
    return F.coalesce(*(F.when(text.rlike(f"(?i){p}"), F.lit(v)) for p, v in rules), F.lit(None))


def risk_summary(rankings: DataFrame, evaluator: str = "auto_evaluator") -> DataFrame:
    """Counts of levels and of risk factors named, over the lines of an evaluator's notes: kind, name, n.  A line opens
    one level at most; names that no line has are left out, levels aren't."""
    lines = rankings.where((F.col("evaluator_id") == evaluator) & (F.col("reasoning_text") != "")).select(F.explode(F.split("reasoning_text", "\n")).alias("line"))
    low, c = F.lower("line"), F.col("line")
    level = F.when(c.contains(RISK_LEVELS[0][1]), "high").when(c.contains(RISK_LEVELS[1][1]), "medium").when(c.contains(RISK_LEVELS[2][1]), "low")
    counts = [F.count_if(level == k).alias(k) for k, _ in RISK_LEVELS] + [F.count_if(low.contains(r)).alias(r) for r in RISK_NAMES]
    entries = [F.struct(F.lit("level").alias("kind"), F.lit(k).alias("name"), F.col(k).alias("n")) for k, _ in RISK_LEVELS]
    entries += [F.struct(F.lit("factor").alias("kind"), F.lit(r).alias("name"), F.col(r).alias("n")) for r in RISK_NAMES]
    return lines.agg(*counts).select(F.inline(F.array(*entries))).where("kind = 'level' or n > 0")


def tone_distribution(results: DataFrame) -> DataFrame:
    """How often each tone, and each strength of claim by endpoint, occurs: section, key, value, n."""
    tones = results.groupBy(F.col("overall_tone").alias("value")).agg(F.count("*").alias("n")).select(F.lit("tone").alias("section"), F.lit("").alias("key"), "value", "n")
    claims = results.select(F.explode("claim_strength").alias("key", "value")).groupBy("key", "value").agg(F.count("*").alias("n"))
    return tones.unionAll(claims.select(F.lit("claim").alias("section"), "key", "value", "n"))


def tone_confidence(results: DataFrame) -> DataFrame:
    """Least (1 at most), greatest (0 at least) and mean confidence; without results 1, 0 and 0."""
    c = F.col("confidence")
    return results.agg(F.least(F.min(c), F.lit(1.0)).alias("min"), F.greatest(F.max(c), F.lit(0.0)).alias("max"), F.coalesce(F.sum(c) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("avg"))


def tone_examples(results: DataFrame, column: str, order: str, each: int = 3, limit: int = 10) -> DataFrame:
    """The first examples of a column of lists, a few a row, in order of the rows: at most `limit` rows are opened."""
    rows = results.where(F.size(column) > 0).select(order, F.slice(column, 1, each).alias("x")).orderBy(order).limit(limit)
    return rows.select(order, F.posexplode("x").alias("place", "example")).orderBy(order, "place").limit(limit)


def subsidiary_exhibits(filings: DataFrame, companies: DataFrame, docs: DataFrame, since: Column, limit: int = 100) -> DataFrame:
    """Documents of annual reports that list subsidiaries, by type or description, newest first, then by number and path."""
    annual = filings.where(F.col("form").isin(*ANNUAL_FORMS) & (F.col("filing_date") >= since)).withColumn("cik", F.col("cik").try_cast("long"))
    lists = docs.where(F.upper("doc_type").like("EX-21%") | F.col("description").ilike("%subsidiar%"))
    kept = lists.select("accession", F.coalesce("doc_type", F.lit("")).alias("doc_type"), F.coalesce("description", F.lit("")).alias("doc_description"), "local_path")
    both = annual.join(kept, "accession").join(companies.select("company_id", "cik"), "cik")
    return both.select("company_id", "cik", "form", "filing_date", "accession", "doc_type", "doc_description", "local_path").orderBy(F.desc("filing_date"), "accession", "local_path").limit(limit)


def norm_in_text(name: Column) -> Column:
    """A name from a text: ASCII letters and digits in lower case, without endings of companies and of the trade."""
    tails = "|".join(t.replace(".", r"\.") for t in NAME_TAILS)
    words = F.trim(F.regexp_replace(F.lower(T.ascii_fold(F.coalesce(name, F.lit("")))), "[^a-z0-9]+", " "))
    return F.trim(F.regexp_replace(F.concat(F.lit(" "), words), f"( ({tails}))+$", ""))


def former_names(rows: DataFrame, companies: DataFrame, aliases: DataFrame) -> DataFrame:
    """New aliases from former names (cik, name, date_from, date_to): one for each company and normalised name that
    isn't an alias yet, the earliest first.  Unknown numbers and names of nothing but punctuation go."""
    known = aliases.where("alias_type = 'former_name'").select("company_id", "alias_norm")
    met = rows.join(companies.select("cik", "company_id"), "cik").withColumn("alias_norm", T.norm_name(F.col("name"))).where("alias_norm <> ''")
    one = met.groupBy("company_id", "alias_norm").agg(F.min(F.struct(F.col("date_from"), F.col("name").alias("alias"), F.col("date_to"))).alias("x"))
    return one.select("company_id", "alias_norm", "x.alias", F.lit("former_name").alias("alias_type"), "x.date_from", "x.date_to").join(known, ["company_id", "alias_norm"], "left_anti")


def business_rules(trials: DataFrame, run: bool = False) -> DataFrame:
    """Outcome of the four rules that one trial's row decides: trial_id, rule, outcome (skip, pass, fail).  They are
    skipped, as they are where they come from, unless `run`, an extension that takes their own limits; a rule
    whose fields are null is skipped then too."""

    def outcome(ok: Column) -> Column:
        return F.coalesce(F.when(ok, "pass").when(~ok, "fail"), F.lit("skip")) if run else F.lit("skip")

    days = F.datediff("completion_date", "start_date")
    phases = F.array(*(F.lit(p) for p in PHASE_ORDER))
    place = lambda c: F.nullif(F.array_position(phases, F.col(c)), F.lit(0))
    rules = {
        "enrollment_targets": F.col("enrollment").between(*ENROLLMENT_RANGE),
        "trial_duration": days.between(*DURATION_RANGE),
        "trial_phase_progression": place("phase") >= place("last_phase"),
        "sponsor_company_link": F.when(F.col("sponsor_text").isNotNull(), F.col("company_id").isNotNull()),
    }
    return trials.select("trial_id", F.inline(F.array(*(F.struct(F.lit(k).alias("rule"), outcome(ok).alias("outcome")) for k, ok in rules.items()))))
