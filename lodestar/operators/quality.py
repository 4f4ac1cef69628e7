"""Study-card quality, guardrails and rule-based data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the four categories, phases that are valid, formats.
CATEGORY_WEIGHTS = {"required": 0.40, "evidence": 0.30, "advanced": 0.20, "metadata": 0.10}
PHASES = ("PHASE1", "PHASE2", "PHASE3", "PHASE4", "PHASE2_PHASE3")
CIK_FORMAT, TICKER_FORMAT = r"^\d{10}$", r"^[A-Z]{1,5}$"


def share(present: list[Column]) -> Column:
    """Share of conditions that hold; a null condition doesn't."""
    total = F.lit(0)
    for p in present:
        total = total + F.when(p, 1).otherwise(0)
    return total / F.lit(float(len(present)))


def overall(categories: dict[str, Column]) -> Column:
    out = F.lit(0.0)
    for k, c in categories.items():
        out = out + CATEGORY_WEIGHTS[k] * c
    return out / F.lit(sum(CATEGORY_WEIGHTS.values()))


def rank_of(score: Column) -> Column:
    """1 to 10 by steps of a tenth, compared with the steps one by one."""
    out = F.lit(1)
    for k in range(1, 10):
        out = F.when(score >= k / 10, k + 1).otherwise(out)
    return out


def confidence_of(categories: dict[str, Column], score: Column) -> Column:
    """The score less half the categories' variance (0.2 at most), within 0 and 1."""
    xs = list(categories.values())
    mean = sum(xs[1:], xs[0]) / len(xs)
    squares = [(x - mean) * (x - mean) for x in xs]
    spread = sum(squares[1:], squares[0]) / len(xs)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score - F.least(F.lit(0.2), spread * 0.5)))


def filled(c: Column) -> Column:
    """An array with members."""
    return F.coalesce(F.size(c) > 0, F.lit(False))


def card_categories(c: Column) -> dict[str, Column]:
    """Shares of the fields of an extracted study card that are there."""
    first = lambda a: F.get(a, F.lit(0))
    return {
        "required": share([c["trial"]["nct_id"].isNotNull(), c["trial"]["phase"].isNotNull(), c["trial"]["indication"].isNotNull(), c["trial"]["is_pivotal"].isNotNull(), c["primary_endpoints"].isNotNull(), c["arms"].isNotNull(), c["sample_size"]["total_n"].isNotNull(), c["results"]["primary"].isNotNull()]),
        "evidence": share([filled(first(c["primary_endpoints"])["evidence"]), filled(first(c["results"]["primary"])["evidence"]), filled(c["populations"]["itt"]["evidence"]), filled(c["populations"]["pp"]["evidence"]), filled(first(c["arms"])["evidence"]), filled(c["sample_size"]["evidence"])]),
        "advanced": share([filled(c["protocol_changes"]), filled(c["contradictions"]), filled(c["results"]["interim_looks"]), filled(c["results"]["subgroups"]), filled(c["signals"])]),
        "metadata": share([F.coalesce(c["coverage_level"], F.lit("")) != "", F.coalesce(c["coverage_rationale"], F.lit("")) != "", filled(c["extraction_audit"]["missing_fields"]), filled(c["extraction_audit"]["assumptions"])]),
    }


def card_quality(cards: DataFrame, card: str = "card") -> DataFrame:
    """Adds score, rank and confidence of each card."""
    parts = card_categories(F.col(card))
    one = cards.select("*", *(v.alias(f"q_{k}") for k, v in parts.items()))
    named = {k: F.col(f"q_{k}") for k in parts}
    return one.withColumn("score", overall(named)).withColumn("rank", rank_of(F.col("score"))).withColumn("confidence", confidence_of(named, F.col("score")))


def missing_essentials(endpoints: Column, total_n: Column, analysed_on: Column, effect_or_p: Column) -> Column:
    """Names of the four essentials that a card lacks."""
    lack = lambda c, name: F.when(F.coalesce(c, F.lit(True)), F.lit(name))
    return F.array_compact(F.array(lack(~endpoints, "primary_endpoints"), lack(total_n.isNull(), "sample_size.total_n"), lack(F.coalesce(analysed_on, F.lit("")) == "", "populations.analysis_primary_on"), lack(~effect_or_p, "results.primary.(effect_size.value OR p_value)")))


def essentials_of_card(c: Column) -> Column:
    known = F.exists(F.coalesce(c["results"]["primary"], F.array()), lambda r: r["effect_size"]["value"].isNotNull() | r["p_value"].isNotNull())
    return missing_essentials(filled(c["primary_endpoints"]), c["sample_size"]["total_n"], c["populations"]["analysis_primary_on"], known)


def coverage_level(missing: Column) -> Column:
    return F.when(F.size(missing) == 0, "high").when(F.size(missing) == 1, "med").otherwise("low")


def split_quarantine(cards: DataFrame, is_pivotal: Column, missing: Column) -> tuple[DataFrame, DataFrame]:
    """All cards, and the pivotal ones that lack essentials (they are kept as well)."""
    bad = cards.where(F.coalesce(is_pivotal, F.lit(False)) & (F.size(missing) > 0)).withColumn("errors", missing)
    return cards, bad


def outcome(name: str, severity: str, status: Column) -> Column:
    return F.struct(F.lit(name).alias("rule_id"), F.lit(severity).alias("severity"), status.alias("status"))


def required(*fields: str) -> Column:
    gone = F.lit(False)
    for f in fields:
        gone = gone | F.col(f).isNull() | (F.col(f).cast("string") == "")
    return F.when(gone, "FAIL").otherwise("PASS")


def trial_rules() -> list[Column]:
    """Rules on trials(nct_id, brief_title, sponsor_name, phase, study_start, primary_completion,
    study_completion, enrollment_count); dates and counts may be texts."""
    start, primary, end = (F.col(c).try_cast("timestamp") for c in ("study_start", "primary_completion", "study_completion"))
    known = start.isNotNull().cast("int") + primary.isNotNull().cast("int") + end.isNotNull().cast("int")
    wrong = F.coalesce(start > end, F.lit(False)) | F.coalesce(primary > end, F.lit(False))
    size = F.col("enrollment_count").try_cast("int")
    return [
        outcome("trial_required_fields", "critical", required("nct_id", "brief_title", "sponsor_name", "phase")),
        outcome("trial_phase_valid", "high", F.when(F.coalesce("phase", F.lit("")) == "", "WARNING").when(F.col("phase").isin(*PHASES), "PASS").otherwise("FAIL")),
        outcome("trial_dates_consistent", "medium", F.when(known < 2, "SKIP").when(wrong, "FAIL").otherwise("PASS")),
        outcome("trial_enrollment_positive", "medium", F.when(F.col("enrollment_count").isNull(), "SKIP").when(size > 0, "PASS").otherwise("FAIL")),
    ]


def company_rules() -> list[Column]:
    """Rules on companies(cik, company_name, ticker)."""
    return [
        outcome("company_required_fields", "critical", required("cik", "company_name", "ticker")),
        outcome("company_cik_format", "high", F.when(F.coalesce(F.col("cik").rlike(CIK_FORMAT), F.lit(False)), "PASS").otherwise("FAIL")),
        outcome("company_ticker_format", "medium", F.when(F.coalesce("ticker", F.lit("")) == "", "SKIP").when(F.col("ticker").rlike(TICKER_FORMAT), "PASS").otherwise("FAIL")),
    ]


def check(rows: DataFrame, key: str, rules: list[Column], disabled: tuple[str, ...] = ()) -> DataFrame:
    """Long results: key, rule_id, severity, status; one pass, no shuffle."""
    out = rows.select(F.col(key), F.explode(F.array(*rules)).alias("r")).select(key, "r.*")
    return out.where(~F.col("rule_id").isin(*disabled)) if disabled else out


def metrics(results: DataFrame, *by: str) -> DataFrame:
    """Counts by status and severity of failures, and passes over passes and failures."""
    n = lambda s: F.count_if(F.col("status") == s)
    failed = lambda s: F.count_if((F.col("status") == "FAIL") & (F.col("severity") == s))
    return results.groupBy(*by).agg(n("PASS").alias("passed"), n("FAIL").alias("failed"), n("WARNING").alias("warnings"), n("SKIP").alias("skipped"), failed("critical").alias("critical"), failed("high").alias("high"), F.try_divide(n("PASS"), n("PASS") + n("FAIL")).alias("score"))
