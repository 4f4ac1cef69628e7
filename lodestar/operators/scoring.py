"""Failure probability: prior, gates, stop rules, posterior, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.stats import clamp, logistic, logit
from lodestar.operators.gates import GATES

# The prior and its factors, bounds, and the level that a stop rule forces.
PRIOR, PRIOR_BOUNDS = 0.15, (0.01, 0.50)
FACTORS = {"pivotal": 1.2, "other": 0.8, "oncology": 1.1, "rare": 0.9, "phase_3": 1.1, "phase_1": 0.8}
LR_BOUNDS, LOGIT_BOUNDS, POSTERIOR_PRIOR_BOUNDS = (0.25, 10.0), (-8.0, 8.0), (0.01, 0.99)
STOP_LEVEL = 0.97


def prior(is_pivotal: Column, indication: Column, phase: Column) -> Column:
    i, p = F.lower(F.coalesce(indication, F.lit(""))), F.lower(F.coalesce(phase, F.lit("")))
    x = PRIOR * F.when(is_pivotal, FACTORS["pivotal"]).otherwise(FACTORS["other"])
    x = x * F.when(i.contains("oncology"), FACTORS["oncology"]).when(i.contains("rare_disease"), FACTORS["rare"]).otherwise(1.0)
    x = x * F.when(p.contains("phase_3"), FACTORS["phase_3"]).when(p.contains("phase_1"), FACTORS["phase_1"]).otherwise(1.0)
    return clamp(x, *PRIOR_BOUNDS)


def sum_log_lr(gates: tuple[str, ...] = tuple(GATES)) -> Column:
    out = F.lit(0.0)
    for g in gates:
        out = out + F.when(F.col(g)["fired"], F.log(clamp(F.col(g)["lr"], *LR_BOUNDS))).otherwise(0.0)
    return out


def posterior(prior_pi: Column, log_lr: Column) -> Column:
    """Struct (prior_pi, logit_prior, sum_log_lr, logit_post, p_fail)."""
    pi = clamp(prior_pi, *POSTERIOR_PRIOR_BOUNDS)
    post = clamp(logit(pi) + log_lr, *LOGIT_BOUNDS)
    return F.struct(pi.alias("prior_pi"), logit(pi).alias("logit_prior"), log_lr.alias("sum_log_lr"), post.alias("logit_post"), logistic(post).alias("p_fail"))


def stop_rules(s1: Column, s4: Column, s1_late: Column, s4_missing: Column, s8_unblinded: Column) -> Column:
    """Names of the stop rules that hit; the three flags come with the input and default to false."""
    hit = lambda c, name: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    return F.array_compact(F.array(hit(s1 & s1_late, "endpoint_switched_after_LPR"), hit(s4 & s4_missing, "pp_only_success_with_missing_itt_gt20"), hit(s8_unblinded, "unblinded_subjective_primary_feasible_blinding")))


def score(gated: DataFrame, is_pivotal: Column, indication: Column, phase: Column, flags: tuple[Column, Column, Column] | None = None) -> DataFrame:
    """Adds prior_pi, logit_prior, sum_log_lr, logit_post, stops and p_fail; no shuffle.

    A stop rule can only raise p_fail.
    """
    late, missing, unblinded = flags or (F.lit(False),) * 3
    rules = stop_rules(F.col("S1")["fired"], F.col("S4")["fired"], late, missing, unblinded)
    out = gated.withColumn("_p", posterior(prior(is_pivotal, indication, phase), sum_log_lr())).withColumn("stops", rules)
    p = F.when(F.size("stops") > 0, F.greatest(F.col("_p.p_fail"), F.lit(STOP_LEVEL))).otherwise(F.col("_p.p_fail"))
    return out.select("*", "_p.prior_pi", "_p.logit_prior", "_p.sum_log_lr", "_p.logit_post", p.alias("p_fail")).drop("_p")


def audit(run_id: str) -> Column:
    """The score's audit trail as JSON."""
    gates = F.struct(*(F.struct(F.col(g)["fired"].alias("fired"), F.col(g)["lr"].alias("lr"), F.col(g)["supporting"].alias("supporting")).alias(g) for g in GATES))
    return F.to_json(F.struct(F.lit(run_id).alias("run_id"), "trial_id", F.round("prior_pi", 6).alias("prior_pi"), F.round("sum_log_lr", 6).alias("sum_log_lr"), F.round("logit_post", 6).alias("logit_post"), F.round("p_fail", 6).alias("p_fail"), "stops", gates.alias("gates")))


def risk_band(p: Column) -> Column:
    return F.when(p > 0.7, "H").when(p > 0.4, "M").otherwise("L")


def batch_statistics(scored: DataFrame) -> DataFrame:
    """Counts by risk band and the mean probability."""
    band = risk_band(F.col("p_fail"))
    return scored.agg(F.count("*").alias("n"), F.avg("p_fail").alias("mean_p_fail"), F.count_if(band == "H").alias("high"), F.count_if(band == "M").alias("medium"), F.count_if(band == "L").alias("low"))


def report(scored: DataFrame) -> DataFrame:
    """Risk band, what drives it, and what to do, per trial."""
    drivers = F.array_compact(F.array(
        *(F.when(F.col(g)["fired"], F.lit(t)) for g, t in (("G1", "late endpoint change in an underpowered trial"), ("G2", "subgroup wins with an analysis-set contradiction"), ("G3", "implausible effect in a hard class"), ("G4", "p-value at the edge of significance"))),
        *(F.when(F.col(s)["fired"] & (F.col(s)["severity"] == "H"), F.lit(f"{s} high")) for s in ("S2", "S6", "S7", "S9")),
    ))
    advice = F.when(F.col("p_fail") > 0.7, "avoid or hedge").when(F.col("p_fail") > 0.4, "review by hand").otherwise("monitor")
    return scored.select("trial_id", "p_fail", risk_band(F.col("p_fail")).alias("band"), drivers.alias("drivers"), advice.alias("advice"))
