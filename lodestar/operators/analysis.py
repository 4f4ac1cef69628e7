"""Analyses of study cards and publications: evaluation, reviewer scores, confidence, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.catalyst import number_rows

# Shares of an evaluation, penalties of validation issues, grades, quality steps.
EVALUATION = {"quality": 0.4, "extraction": 0.3, "validation": 0.2, "risk": 0.1}
ISSUE_PENALTY = {"error": 25.0, "warning": 10.0, "info": 2.0}
GRADES = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
EVIDENCE_BONUS = {"strong": 0.3, "moderate": 0.2, "weak": 0.1}
IMPACT_RANGES = ((2.0, "< 2.0"), (5.0, "2.0 - 4.9"), (10.0, "5.0 - 9.9"))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def evaluation_score(quality: Column, completeness: Column, validation: Column, risk_penalty: Column) -> Column:
    """Quality, extraction and validation (0 to 100) less a tenth of the risk penalty (0.5 at most)."""
    e = EVALUATION
    return clamp01(e["quality"] * quality + e["extraction"] * completeness + e["validation"] * validation / 100.0 - e["risk"] * F.least(F.lit(0.5), risk_penalty))


def evaluation_confidence(quality: Column, extraction: Column, issues: Column, risks: Column) -> Column:
    checked = clamp01((100.0 - issues * 0.5) / 100.0)
    return clamp01(0.4 * quality + 0.3 * extraction + 0.2 * checked + 0.1 * F.greatest(F.lit(0.0), 1 - 0.1 * risks))


def completeness(extracted: Column, partial: Column, total: Column) -> Column:
    """Fields found, half for partial ones, over all; 0 without fields."""
    return F.coalesce(F.try_divide(extracted + 0.5 * partial, total), F.lit(0.0))


def validation_score(errors: Column, warnings: Column, infos: Column, complete: Column) -> Column:
    """100 less the issues' penalties, at 0.7, and completeness at 0.3; 0 to 100."""
    p = ISSUE_PENALTY
    base = F.greatest(F.lit(0.0), 100.0 - p["error"] * errors - p["warning"] * warnings - p["info"] * infos)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 0.7 * base + 0.3 * 100 * complete))


def grade(score: Column) -> Column:
    return reduce(lambda c, g: c.when(score >= g[0], g[1]), GRADES[1:], F.when(score >= GRADES[0][0], GRADES[0][1])).otherwise("F")


def reviewer_score(complete: Column, evidence: Column, critical: Column, major: Column, oddities: Column) -> Column:
    bonus = reduce(lambda c, g: c.when(evidence == g[0], g[1]), list(EVIDENCE_BONUS.items())[1:], F.when(evidence == "strong", EVIDENCE_BONUS["strong"])).otherwise(0.0)
    return clamp01(0.4 * complete + bonus - 0.2 * critical - 0.1 * major - 0.02 * oddities)


def reviewer_rating(score: Column) -> Column:
    return F.when(score >= 0.8, "excellent").when(score >= 0.6, "good").when(score >= 0.4, "fair").otherwise("poor")


def reviewer_confidence(issues: Column, chars: Column) -> Column:
    return F.least(F.lit(1.0), 0.5 + F.least(F.lit(0.3), issues * 0.05) + F.least(F.lit(0.2), chars / F.lit(5000.0)) - F.when(issues > 20, 0.1).otherwise(0.0))


def tone_confidence(cautious: Column, definite: Column, chars: Column) -> Column:
    """More matches, more balance and more text: more confidence; 0 without text, 0.3 without a match."""
    a, b = cautious / chars * 1000, definite / chars * 1000
    balance = 1 - F.abs(a - b) / F.greatest(a + b, F.lit(1.0))
    x = ((cautious + definite) / 10 + balance + F.least(chars / F.lit(1000.0), F.lit(1.0))) / 3
    return F.when(chars == 0, 0.0).when(cautious + definite == 0, 0.3).otherwise(F.least(x, F.lit(1.0)))


def conflict_confidence(conflicts: Column, funding: Column, chars: Column) -> Column:
    x = 0.5 + F.when((conflicts > 0) | (funding > 0), 0.3).otherwise(0.0) + F.least(chars / F.lit(2000.0), F.lit(0.2))
    return F.when(chars == 0, 0.0).otherwise(F.least(x, F.lit(1.0)))


def publication_confidence(journal_type: Column, name: Column, impact: Column, open_access: Column) -> Column:
    some = lambda c, w: F.when(F.coalesce(c, F.lit(False)), w).otherwise(0.0)
    return F.least(F.lit(1.0), 0.3 + some(journal_type != "other", 0.2) + some(name != "", 0.2) + some(impact != 0, 0.2) + some(open_access.isNotNull(), 0.1))


def location_confidence(tables: Column, figures: Column, quotes: Column) -> Column:
    n = tables + figures + quotes
    some = lambda c, w: F.when(c > 0, w).otherwise(0.0)
    return F.when(n == 0, 0.1).otherwise(F.least(F.lit(1.0), 0.3 + F.least(n / F.lit(10.0), F.lit(0.5)) + some(tables, 0.2) + some(figures, 0.2) + some(quotes, 0.1)))


def claim_strength(with_evidence: Column, claims: Column) -> Column:
    """Strong from 0.7 of claims with evidence, moderate from 0.4; no claims at all is strong."""
    return F.when(with_evidence >= 0.7 * claims, "strong").when(with_evidence >= 0.4 * claims, "moderate").otherwise("weak")


def final_positions(evaluated: DataFrame) -> DataFrame:
    """Positions by rank, then enhanced score, then quality, and whether a study is of high risk: rank 7 or
    more, among the last fifth, or confidence under 0.3.

    evaluated(study_id, quality_rank, llm_score, quality, confidence).  Lower ranks come first, as published.
    """
    order = [F.asc("quality_rank"), F.desc(F.coalesce("llm_score", F.lit(0.0))), F.desc("quality"), F.asc("study_id")]
    out = number_rows(evaluated, order)
    n = evaluated.agg(F.count("*").alias("_all"))
    risky = (F.col("quality_rank") >= 7) | (F.col("position") > F.col("_all") * 0.8) | (F.col("confidence") < 0.3)
    return out.join(F.broadcast(n)).withColumn("high_risk", risky).drop("_all")  # one row


def high_risk(analysed: DataFrame, threshold: int = 7) -> DataFrame:
    """quality_rank at or over the threshold, critical issues, three major ones, or weak evidence."""
    return analysed.where((F.col("quality_rank") >= threshold) | (F.col("critical") > 0) | (F.col("major") >= 3) | F.col("evidence").isin("weak", "insufficient"))


def impact_range(impact: Column) -> Column:
    """Bucket of a known impact factor; 0 counts as unknown."""
    known = F.when(F.coalesce(impact, F.lit(0.0)) == 0, F.lit(None).cast("string"))
    return reduce(lambda c, r: c.when(impact < r[0], r[1]), IMPACT_RANGES, known).otherwise("≥ 10.0")


def publication_report(pubs: DataFrame) -> DataFrame:
    """Per journal type: publications, impact factors' sum over all of them, open and reviewed ones."""
    return pubs.groupBy("journal_type").agg(F.count("*").alias("n"), (F.sum(F.coalesce("impact_factor", F.lit(0.0))) / F.count("*")).alias("mean_impact"), F.count_if("open_access").alias("open_access"), F.count_if("peer_reviewed").alias("peer_reviewed"))


def transparency(funding_sources: Column) -> Column:
    return F.when(funding_sources >= 2, "full").when(funding_sources == 1, "partial").otherwise("none")


def distribution(df: DataFrame, **dims: Column) -> DataFrame:
    """Counts of each value of several dimensions in one pass: dim, value, n."""
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("dim"), c.cast("string").alias("value")) for k, c in dims.items())))
    return df.select(rows.alias("r")).groupBy("r.dim", "r.value").agg(F.count("*").alias("n"))


def link_metrics(audit: DataFrame, gold: DataFrame, by: str = "heuristic") -> DataFrame:
    """Precision, recall and F1 per heuristic against gold(doc_id, asset_id)."""
    total = gold.distinct().agg(F.count("*").alias("gold"))
    hit = audit.select(by, "doc_id", "asset_id").distinct().join(gold.distinct().withColumn("_g", F.lit(True)), ["doc_id", "asset_id"], "left")
    out = hit.groupBy(by).agg(F.count("*").alias("links"), F.count("_g").alias("correct")).join(F.broadcast(total))  # one row
    p, r = F.try_divide("correct", "links"), F.try_divide("correct", "gold")
    return out.select(by, "links", "correct", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def token_pairs(tokens: Column) -> Column:
    """Sorted pairs of distinct tokens, joined by a bar: keys of a blocking join."""
    t = F.array_sort(F.array_distinct(tokens))
    pairs = F.transform(t, lambda a, i: F.transform(F.slice(t, i + 2, F.greatest(F.size(t) - i - 1, F.lit(0))), lambda b: F.concat_ws("|", a, b)))
    return F.flatten(pairs)


def trailing_quality(results: DataFrame, now: Column, days: int) -> DataFrame:
    """Mean score of the last days, and how many results there were."""
    recent = results.where(F.col("ts").cast("timestamp") >= now.cast("timestamp") - F.make_interval(days=F.lit(days)))
    return recent.agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"))


def company_facts(companies: DataFrame, aliases: DataFrame, securities: DataFrame, most: int = 5) -> DataFrame:
    """Each company's name, up to five aliases (by kind, then newest) and active tickers (newest first)."""
    w = Window.partitionBy("company_id").orderBy("type_rank", F.desc("created_at"), "alias")
    top = aliases.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most).groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("rn", "alias"))).alias("a"))
    live = securities.where("valid_to is null").groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("valid_from", "ticker")), asc=False).alias("t"))
    out = companies.join(top, "company_id", "left").join(live, "company_id", "left")
    none = F.array().cast("array<string>")
    return out.select("company_id", "name", F.coalesce(F.transform("a", lambda x: x["alias"]), none).alias("aliases"), F.coalesce(F.transform("t", lambda x: x["ticker"]), none).alias("tickers"))


def scan_counters(current: DataFrame, incoming: DataFrame, key: str, digest: str) -> DataFrame:
    """How many incoming rows are new, updated or unchanged."""
    old = current.select(key, F.col(digest).alias("_old"))
    kind = F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col(digest), "unchanged").otherwise("updated")
    return incoming.join(old, key, "left").groupBy(kind.alias("state")).agg(F.count("*").alias("n"))


def typed_changes(old: dict[str, Column], new: dict[str, Column], significance: dict[str, str], numeric: dict[str, float] | None = None) -> Column:
    """Array of (field, change_type, significance) for fields that differ; numeric ones only from a relative
    change on, unless one side is missing."""
    items = []
    for f, a in old.items():
        b = new[f]
        differs = ~a.eqNullSafe(b)
        if numeric and f in numeric:
            differs = differs & F.coalesce(F.try_divide(F.abs(b - a).cast("double"), a) >= numeric[f], F.lit(True))
        kind = F.when(a.isNull(), "ADDED").when(b.isNull(), "REMOVED").otherwise("MODIFIED")
        items.append(F.when(differs, F.struct(F.lit(f).alias("field"), kind.alias("change_type"), F.lit(significance.get(f, "LOW")).alias("significance"))))
    return F.array_compact(F.array(*items))


def scan_since(last: Column, configured: Column, today: Column, full: Column) -> Column:
    """Where an incremental scan starts: the configured day for a full one, two days before the last scan,
    or a week ago."""
    return F.when(full, configured).otherwise(F.coalesce(F.date_sub(last, 2), F.date_sub(today, 7)))


def relevant_sections(sections: DataFrame) -> DataFrame:
    """Sections of high or medium relevance, and long ones of low."""
    return sections.where(F.col("relevance").isin("HIGH", "MEDIUM") | ((F.col("relevance") == "LOW") & (F.length("text") > 500)))
