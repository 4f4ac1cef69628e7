"""Study cards, decisions, listings and corporate families: rules over one row or one key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators.resolve import candidates

# What a place and a preview of evidence count, and scores of coverage levels.
PLACE_WEIGHT, PREVIEW_WEIGHT = 0.6, 0.4
COVERAGE = {"high": 1.0, "med": 0.7, "medium": 0.7, "low": 0.4}
COVERAGE_ELSE = 0.5
# Limits of the risk factors.
LEAST_POWER, LEAST_PATIENTS = 0.7, 100
# First score and width of the bands of the base score.
BANDS = ((3, 1, 30), (6, 31, 30), (None, 61, 39))
# Confidence by type of link.
LINK_TYPES = {"nct_near_asset": 1.00, "code_in_text": 0.90, "inn_in_text": 0.85, "exact_intervention_match": 0.95}
# Words that make a text cautious or definitive.
CAUTIOUS_WORDS = ("may", "might", "could", "suggest", "indicate", "appear", "seem", "trend", "tendency", "potential", "possible", "likely", "probably")
DEFINITIVE_WORDS = ("prove", "demonstrate", "establish", "confirm", "verify", "show", "conclude", "determine", "find", "reveal", "identify", "discover")
# Fields that two versions of a record are compared by; those that matter.
DIFF_FIELDS = ("briefTitle", "officialTitle", "phase", "status", "sampleSize", "primaryEndpoint", "analysisPlan")
DIFF_MATTERS = ("phase", "status", "sampleSize", "primaryEndpoint")
# Labels of a fuzzy match by similarity.
FUZZY_HIGH, FUZZY_MODERATE = 0.8, 0.6
# Wordings of former names, trade names and subsidiaries; the first group is the name.
FORMER = (r"(?is)\(\s*formerly\s+known\s+as\s+([^)]+?)\s*\)", r"(?is)\bformerly\s+known\s+as\s+(.+?)(?:[);,\.]|$)")
TRADE = (r"(?is)\b(?:is\s+)?(?:doing\s+business\s+as|d/b/a)\s+([A-Z][A-Za-z0-9&.\- ]+?)(?:(?:\s+(?:in|within|for)\b)|[),.;]|$)",)
SUBSIDIARY = (
    r"(?is)([A-Z][^,]+?(?:,\s*(?:Inc\.|Incorporated|Corp\.|Corporation|Co\.|Company|Ltd\.|LLC|PLC|N\.V\.|S\.A\.))?)\s*,\s*(?:an?\s+)?(?:indirect\s+)?(?:wholly(?:-| )?owned\s+)?subsidiary\s+of\b",
    r"(?is)([A-Z][A-Za-z0-9&.\- ]+?)\s+is\s+(?:an?\s+)?(?:indirect\s+)?(?:wholly(?:-| )?owned\s+)?subsidiary\s+of\b",
)
KEEPS_DOT = ("inc.", "co.", "corp.", "ltd.", "s.a.")


def evidence_quality(spans: Column) -> Column:
    """Mean worth of evidence (loc, text_preview); none: 0."""
    worth = lambda e: F.when(F.coalesce(e["loc"], F.lit("")) != "", PLACE_WEIGHT).otherwise(0.0) + F.when(F.coalesce(e["text_preview"], F.lit("")) != "", PREVIEW_WEIGHT).otherwise(0.0)
    total = F.aggregate(F.transform(spans, worth), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, total / F.size(spans)).otherwise(0.0)


def coverage_quality(level: Column) -> Column:
    return reduce(lambda w, kv: w.when(F.lower(level) == kv[0], kv[1]), COVERAGE.items(), F.when(F.lit(False), 0.0)).otherwise(COVERAGE_ELSE)


def risk_factors(late_changes: Column, power: Column, patients: Column, subgroup_wins: Column, primary_win: Column, both_populations: Column, analysed_on: Column) -> Column:
    """Wording of each risk of a card, in a fixed order: an entry per change after the last patient's entry and per
    winning subgroup without a winning endpoint.  patients is only looked at without a power."""
    small = F.when(power.isNull() | (power == 0), F.when(patients < LEAST_PATIENTS, F.concat(F.lit("Small sample size: "), patients.cast("string")))).when(power < LEAST_POWER, F.format_string("Underpowered study (power: %.2f)", power))
    wins = F.coalesce(F.size(F.filter(subgroup_wins, lambda w: w)), F.lit(0))
    alone = F.when(~F.coalesce(primary_win, F.lit(False)) & (wins > 0), F.array_repeat(F.lit("Subgroup-only win without primary success"), wins))
    other = F.when(F.coalesce(both_populations, F.lit(False)) & (analysed_on == "PP"), F.lit("Primary analysis on PP population instead of ITT"))
    none = F.array().cast("array<string>")
    first = F.array_repeat(F.lit("Protocol change after LPR (S1)"), F.coalesce(late_changes, F.lit(0)))
    return F.concat(first, F.array_compact(F.array(small)), F.coalesce(alone, none), F.array_compact(F.array(other)))


def fallback_score(base: Column, quality: Column) -> Column:
    """Score of 1 to 100 within the band of the base score, by the card's quality; cut to a whole number."""
    out = F.when(F.lit(False), F.lit(0))
    for top, first, width in BANDS:
        value = (first + quality * width).cast("int")
        out = out.otherwise(value) if top is None else out.when(base <= top, value)
    return out


def link_confidence(kind: Column, otherwise: Column) -> Column:
    return reduce(lambda w, kv: w.when(kind == kv[0], kv[1]), LINK_TYPES.items(), F.when(F.lit(False), 0.0)).otherwise(otherwise)


def simple_tone(text: Column) -> Column:
    """Which of two word lists has more words that occur anywhere in the text; null for none."""
    t = F.lower(text)
    n = lambda words: reduce(lambda a, w: a + F.when(t.contains(w), 1).otherwise(0), words, F.lit(0))
    a, b = n(CAUTIOUS_WORDS), n(DEFINITIVE_WORDS)
    return F.when(F.coalesce(text, F.lit("")) == "", None).when(b > a, "definitive").when(a > b, "cautious").otherwise("neutral")


def field_changes(old: dict[str, Column], new: dict[str, Column]) -> Column:
    """Struct (changes: field, old, new; significant: names; their counts) over the fields that differ."""
    one = [F.when(~old[f].eqNullSafe(new[f]), F.struct(F.lit(f).alias("field"), old[f].cast("string").alias("old"), new[f].cast("string").alias("new"))) for f in DIFF_FIELDS]
    changes = F.array_compact(F.array(*one))
    matters = F.filter(F.transform(changes, lambda c: c["field"]), lambda f: f.isin(*DIFF_MATTERS))
    return F.struct(changes.alias("changes"), matters.alias("significant"), F.size(changes).alias("change_count"), F.size(matters).alias("significant_count"))


def resolve_all(sponsors: DataFrame, deterministic: DataFrame, decided: DataFrame) -> DataFrame:
    """One decision a sponsor: a deterministic hit (sponsor, company_id, step) for certain, else what was decided by
    probability (sponsor, mode, company_id, p, margin), else no match."""
    det = deterministic.select("sponsor", F.col("company_id").alias("_d"), "step")
    both = sponsors.select("sponsor").where("sponsor is not null").distinct().join(det, "sponsor", "left").join(decided, "sponsor", "left")
    hit, tried = F.col("step").isNotNull(), F.col("mode").isNotNull()
    kind = F.when(hit, F.concat(F.lit("deterministic:"), "step")).when(tried, F.concat(F.lit("probabilistic:"), "mode")).otherwise("no_match")
    sure = lambda c: F.when(hit, 1.0).otherwise(F.coalesce(c, F.lit(0.0)))
    return both.select("sponsor", F.when(hit, F.col("_d")).otherwise(F.col("company_id")).alias("company_id"), kind.alias("match_type"), sure("p").alias("p_match"), sure("margin").alias("top2_margin"))


def fuzzy_companies(names: DataFrame, companies: DataFrame, least: float = 0.3) -> DataFrame:
    """Company of a written name: name, company_id, confidence, match_type; an equal name first, else the most
    similar in trigrams, labelled by similarity, else uncertain."""
    said = names.select("name").where("name <> ''").distinct()
    clean = F.regexp_replace(F.lower("name"), r"[^\w\s]", "")
    own = said.select("name", clean.alias("_k"))
    same = own.join(companies.select("company_id", F.lower("name").alias("_k")), "_k").groupBy("name").agg(F.min("company_id").alias("_same"))
    unlike = own.join(same, "name", "left_anti")
    near = candidates(unlike.select(F.col("_k").alias("sponsor")), companies, 1, least).select(F.col("sponsor").alias("_k"), F.col("company_id").alias("_near"), "sim")
    both = own.join(same, "name", "left").join(near, "_k", "left")
    exact = F.col("_same").isNotNull()
    label = F.when(exact, "exact").when(F.col("sim") > FUZZY_HIGH, "high_confidence").when(F.col("sim") > FUZZY_MODERATE, "moderate_confidence").when(F.col("sim").isNotNull(), "low_confidence").otherwise("uncertain")
    return both.select("name", F.coalesce("_same", "_near").alias("company_id"), F.when(exact, 1.0).otherwise(F.coalesce("sim", F.lit(0.0))).alias("confidence"), label.alias("match_type"))


def latest_run(rows: DataFrame, keys: list[str], run: str = "run_id") -> DataFrame:
    """All rows of each key's last run: the maximum is aggregated before the shuffle and joined back."""
    last = rows.groupBy(*keys).agg(F.max(run).alias(run))
    return rows.join(last, [*keys, run], "left_semi")


def latest_row(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def candidate_history(found: DataFrame, decisions: DataFrame, trials: DataFrame) -> DataFrame:
    """Candidates (sponsor_norm, company_id) with how often the same text was accepted for the company, and how
    many trials it sponsors."""
    kept = decisions.where("match_type = 'probabilistic:accept' or match_type like 'deterministic:%'")
    accepts = kept.groupBy("sponsor_norm", "company_id").agg(F.count("*").alias("prior_accepts"))
    linked = trials.groupBy(F.col("sponsor_company_id").alias("company_id")).agg(F.count("*").alias("linked_trials"))
    out = found.join(accepts, ["sponsor_norm", "company_id"], "left").join(linked, "company_id", "left")
    return out.na.fill(0, ["prior_accepts", "linked_trials"])


def active_securities(securities: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Active listings on allowed exchanges, with the exchange's code and MIC."""
    allowed = exchanges.where("is_allowed").select("exchange_id", F.col("code").alias("exchange_code"), "mic")
    return securities.where("status = 'active'").join(allowed, "exchange_id")


def low_quality(studies: DataFrame, rankings: DataFrame, evaluator: str = "auto_quality", threshold: int = 5, limit: int = 100) -> DataFrame:
    """The studies that an evaluator scored worst, the least confident first among equals, then by study."""
    bad = rankings.where((F.col("evaluator_id") == evaluator) & (F.col("score_1_10") <= threshold)).select("trial_id", "score_1_10", "confidence_level")
    return studies.join(bad, "trial_id").orderBy("score_1_10", "confidence_level", "study_id").limit(limit)


def quality_summary(metrics: DataFrame, since: Column) -> DataFrame:
    """Means, totals and the current values of quality metrics since a time; one row, null means without any."""
    now = lambda c: F.max_by(c, F.struct("calculated_at", "dataset"))
    some = metrics.where(F.col("calculated_at") >= since)
    return some.agg(
        F.count("*").alias("datasets"), F.avg("overall_quality_score").alias("mean_score"), F.avg("completeness_score").alias("mean_completeness"), now("overall_quality_score").alias("current_score"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("records"), F.coalesce(F.sum("failed_validations"), F.lit(0)).alias("failures"), F.coalesce(F.try_divide(F.sum("failed_validations"), F.sum("total_records")), F.lit(0.0)).alias("failure_rate"),
        F.coalesce(F.sum("critical_issues"), F.lit(0)).alias("critical"), now("critical_issues").alias("current_critical"),
    )


def link_subsidiaries(aliases: DataFrame, edges: DataFrame, kinds: tuple[str, ...] = ("legal", "aka")) -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst) from companies whose canonical alias is a subsidiary alias of another to that one, without
    those that exist; and the aliases without a company, as stubs (alias, alias_norm, parent_id)."""
    norm = F.coalesce(F.nullif(F.col("alias_norm"), F.lit("")), T.norm_name(F.col("alias")))
    subs = aliases.where("alias_type = 'subsidiary'").select(F.col("company_id").alias("parent_id"), "alias", norm.alias("alias_norm")).where("alias_norm <> ''")
    canon = aliases.where(F.col("alias_type").isin(*kinds) & F.col("alias_norm").isNotNull()).select("alias_norm", F.col("company_id").alias("src"))
    new = subs.join(canon, "alias_norm").select("src", F.col("parent_id").alias("dst")).distinct()
    stubs = subs.join(canon.select("alias_norm").distinct(), "alias_norm", "left_anti").select("alias", "alias_norm", "parent_id").distinct()
    return new.join(edges.select("src", "dst"), ["src", "dst"], "left_anti"), stubs


def trimmed(alias: Column) -> Column:
    """A name without trailing punctuation; a last dot stays behind a short form of a company's kind."""
    a = F.regexp_replace(F.trim(alias), r"[\s,;:)\]]+$", "")
    short = F.lower(F.element_at(F.split(a, r"\s+"), -1)).isin(*KEEPS_DOT)
    return F.when(a.endswith(".") & ~short, F.substring(a, F.lit(1), F.length(a) - 1)).otherwise(a)


def names_in_text(docs: DataFrame, company: str, text: str) -> DataFrame:
    """Former names, trade names and subsidiaries that a text gives: company_id, alias_type, alias, alias_norm; one
    row for each type and normalised name, as first found."""

    def of(kind: str, patterns: tuple[str, ...]) -> Column:
        found = F.concat(*(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(p), 1) for p in patterns))
        return F.transform(found, lambda x: F.struct(F.lit(kind).alias("alias_type"), trimmed(x).alias("alias")))

    rows = [of("former_name", FORMER), of("dba", TRADE), of("subsidiary", SUBSIDIARY)]
    each = docs.select(F.col(company).alias("company_id"), F.posexplode(F.concat(*rows)).alias("at", "x")).select("company_id", "at", "x.*").where("alias <> ''")
    return each.withColumn("alias_norm", T.norm_name(F.col("alias"))).groupBy("company_id", "alias_type", "alias_norm").agg(F.min_by("alias", "at").alias("alias"))


def domain_view(aliases: DataFrame, companies: DataFrame) -> DataFrame:
    """Domains of companies, from domain aliases and from websites: company_id, domain, origin."""
    a = aliases.where("alias_type = 'domain'").select("company_id", F.lower("alias").alias("domain"), F.lit("alias").alias("origin"))
    return a.unionAll(companies.where("website_domain is not null").select("company_id", F.lower("website_domain").alias("domain"), F.lit("website").alias("origin")))
