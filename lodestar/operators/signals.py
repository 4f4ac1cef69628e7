"""Warning signals S1 to S9 over all trials at once.

A card is a struct column (see plans.adapters.CARD_STRUCT).  Each signal is a struct
(fired, severity H/M/L, value, reason, low_cert); one that didn't fire has severity L.  A missing
field and a null one are the same: the default applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import stats
from lodestar.functions.text import endpoint_concept

# Bounds of the signals.
POWER_LOW, POWER_VERY_LOW, DEFAULT_DELTA, EVENT_SHARE = 0.70, 0.55, 0.12, 0.6
LATE_DAYS = 180
DROPOUT_GAP, DROPOUT_GAP_HIGH = 0.10, 0.15
CUSP, HEAP, HEAP_LEAST, HEAP_TAIL = (0.045, 0.050), (0.045, 0.055), 10, 0.01
OS_HARM, OS_HARM_HIGH, OS_EVENTS, OS_P, CROSSOVER = 1.10, 1.20, 0.60, 0.20, 0.30


def result(fired: Column, severity: Column, value: Column | None = None, reason: Column | None = None, low_cert: Column | None = None) -> Column:
    hit = F.coalesce(fired, F.lit(False))
    return F.struct(
        hit.alias("fired"),
        F.when(hit, severity).otherwise("L").alias("severity"),
        (F.lit(None).cast("double") if value is None else value.cast("double")).alias("value"),
        (F.lit("") if reason is None else reason).alias("reason"),
        F.coalesce(F.lit(False) if low_cert is None else low_cert, F.lit(False)).alias("low_cert"),
    )


def below(p: Column, bound: float) -> Column:
    """p < bound with a missing p as 1; NaN is never below (Spark sorts it above all numbers)."""
    return F.coalesce(p, F.lit(1.0)) < bound


def s1(versions: DataFrame, trial: str = "trial_id", version: str = "version_id", captured: str = "captured_at", endpoint: str = "endpoint", completion: str = "completion") -> DataFrame:
    """Endpoint changed in substance at most 180 days before the expected completion (or after it).

    Versions in order of capture, ties by version id.  One shuffle on the trial; returns a row per trial:
    fired, severity, n_versions, evidence (versions on either side of a change, each once).
    """
    order = Window.partitionBy(trial).orderBy(captured, version)
    now = versions.select(trial, version, captured, completion, endpoint_concept(F.col(endpoint)).alias("concept"))
    before = now.withColumn("was", F.lag("concept").over(order)).withColumn("was_id", F.lag(version).over(order)).withColumn("n", F.row_number().over(order))
    left = F.datediff(F.col(completion).cast("date"), F.col(captured).cast("date"))
    hit = F.col("was").isNotNull() & (F.col("was") != F.col("concept")) & (left <= LATE_DAYS)
    pairs = F.sort_array(F.collect_list(F.when(hit, F.struct("n", F.col("was_id").cast("string").alias("a"), F.col(version).cast("string").alias("b")))))
    out = before.groupBy(trial).agg(F.count("*").alias("n_versions"), F.coalesce(F.bool_or(hit), F.lit(False)).alias("fired"), pairs.alias("p"))
    evidence = F.array_distinct(F.flatten(F.transform("p", lambda x: F.array(x["a"], x["b"]))))
    return out.select(trial, "n_versions", "fired", F.when(F.col("fired"), "H").otherwise("L").alias("severity"), evidence.alias("evidence"))


def s2(c: Column) -> Column:
    """A pivotal trial with too little power for the difference it claims."""
    plan = c["analysis_plan"]
    one_sided = F.coalesce(plan["one_sided"], F.lit(True))
    n_t, n_c = c["arms"]["t"]["n"], c["arms"]["c"]["n"]
    p_c = F.coalesce(plan["assumed_p_c"], c["historical_control_rate"])
    delta = F.coalesce(plan["assumed_delta_abs"], c["mcid_abs"], F.lit(DEFAULT_DELTA))
    alpha = F.coalesce(plan["alpha"], F.when(one_sided, 0.025).otherwise(0.05))
    sized = (n_t > 0) & (n_c > 0) & p_c.isNotNull()
    share = F.when(sized, stats.power_two_proportions(n_t, n_c, p_c, delta, alpha, ~one_sided))
    planned = F.coalesce(F.when(plan["planned_events"] != 0, plan["planned_events"]), c["events_observed"])
    events = F.coalesce(planned, F.when(c["N_total"] > 0, F.floor(EVENT_SHARE * c["N_total"])))
    ratio = F.coalesce(plan["alloc_ratio"], F.coalesce(n_t, F.lit(1)) / F.greatest(F.coalesce(n_c, F.lit(1)), F.lit(1)))
    known = plan["hr_alt"].isNotNull() & events.isNotNull()
    time = F.when(known, stats.power_logrank(events, plan["hr_alt"], ratio, F.coalesce(plan["alpha"], F.lit(0.05)), F.coalesce(plan["two_sided"], F.lit(True))))
    tte = c["primary_type"] == "tte"
    power = F.when(c["is_pivotal"], F.when(c["primary_type"] == "proportion", share).when(tte, time))
    low = F.when(tte, planned.isNull()).otherwise(plan["assumed_delta_abs"].isNull())
    fired = power < F.when(low, POWER_VERY_LOW).otherwise(POWER_LOW)
    return result(fired, F.when(power < POWER_VERY_LOW, "H").otherwise("M"), power, F.when(fired, F.concat(F.lit("power="), F.format_number(power, 2))).otherwise(""), power.isNotNull() & low)


def s3(c: Column) -> Column:
    """Wins in subgroups alone, neither adjusted for nor planned."""
    won = F.filter(F.coalesce(c["subgroups"], F.expr("array()").cast(SUBGROUPS)), lambda g: below(g["p"], 0.05) & ~F.coalesce(g["adjusted"], F.lit(False)) & ~F.coalesce(g["pre_specified_interaction"], F.lit(False)))
    fired = ~below(c["primary_result"]["ITT"]["p"], 0.05) & (F.size(won) > 0)
    names = F.array_join(F.transform(won, lambda g: F.coalesce(g["name"], F.lit("unnamed"))), ", ")
    return result(fired, F.when(c["narrative_highlights_subgroup"], "H").otherwise("M"), None, F.when(fired, F.concat(F.lit("Subgroup-only wins: "), names)).otherwise(""))


def s4(c: Column) -> Column:
    """Per protocol a win, by intention to treat none, and drop-out differs between arms."""
    itt, pp = c["primary_result"]["ITT"], c["primary_result"]["PP"]
    gap = F.abs(F.coalesce(c["arms"]["t"]["dropout"], F.lit(0.0)) - F.coalesce(c["arms"]["c"]["dropout"], F.lit(0.0)))
    none = (F.coalesce(itt["p"], F.lit(1.0)) >= 0.05) | (F.coalesce(itt["estimate"], F.lit(0.0)) <= 0)
    won = pp.isNotNull() & below(pp["p"], 0.05) & (F.coalesce(pp["estimate"], F.lit(0.0)) > 0)
    fired = none & won & (gap >= DROPOUT_GAP)
    return result(fired, F.when((gap >= DROPOUT_GAP_HIGH) | c["endpoint_subjective_unblinded"], "H").otherwise("M"), F.when(fired, gap))


def s5(c: Column, graveyard: Column, p75: Column, p90: Column) -> Column:
    """An effect that few winners of a class with many failures had."""
    effect = c["primary_result"]["effect_size"]
    fired = F.coalesce(graveyard, F.lit(False)) & (effect >= p75)
    return result(fired, F.when(effect >= p90, "H").otherwise("M"), F.when(fired, effect))


def s6(c: Column) -> Column:
    """Several interim looks without alpha spending, or more looks than planned."""
    plan = c["analysis_plan"]
    looks = F.coalesce(plan["planned_interims"], F.lit(0))
    unspent = (looks >= 2) & (F.coalesce(plan["alpha_spending"], F.lit("")) == "")
    extra = (F.coalesce(c["actual_peeks"], F.lit(0)) > looks) & ~F.coalesce(plan["reallocated_alpha"], F.lit(False))
    return result(unspent | extra, F.when(unspent, "H").otherwise("M"))


def s7(c: Column, rct_required: Column | None = None) -> Column:
    """A pivotal trial with one arm where two are the standard."""
    return result(c["is_pivotal"] & c["single_arm"] & (F.lit(True) if rct_required is None else F.coalesce(rct_required, F.lit(True))), F.lit("H"))


def heap_tail(left: Column, right: Column) -> Column:
    """How likely a programme's heap is by chance; null where nothing is heaped."""
    n = left + right
    return F.when((n >= HEAP_LEAST) & (left >= 2 * right), stats.binomial_upper_tail(left, n))


def s8(c: Column, left: Column | None = None, right: Column | None = None, tail: Column | None = None) -> Column:
    """A primary p-value just under 0.05, or a programme's p-values heaped there.

    left and right count the programme's p-values in [0.045, 0.050) and [0.050, 0.055]; tail, their
    `heap_tail`, may come with the programme instead of being summed for each of its trials.
    """
    p = F.coalesce(c["primary_result"]["ITT"]["p"], F.lit(1.0))
    cusp = (p >= CUSP[0]) & (p <= CUSP[1])
    if tail is None and (left is None or right is None):
        return result(cusp, F.lit("M"), F.when(cusp, p))
    tail = heap_tail(left, right) if tail is None else tail
    heap = F.coalesce(tail < HEAP_TAIL, F.lit(False))
    return result(cusp | heap, F.when(cusp, "M").otherwise("H"), F.when(cusp, p).when(heap, tail))


def s9(c: Column) -> Column:
    """Progression improves while survival gets worse, with many events and little crossover."""
    pfs, os = c["pfs"], c["os"]
    ratio = F.coalesce(os["hr"], F.lit(1.0))
    better = below(pfs["p"], 0.05) | ((F.coalesce(pfs["hr"], F.lit(1.0)) < 1) & (F.coalesce(pfs["ci95_upper"], F.lit(1.01)) < 1))
    harm = (ratio >= OS_HARM) & (F.coalesce(os["events_frac"], F.lit(0.0)) >= OS_EVENTS) & below(os["p"], OS_P)
    few = F.coalesce(os["crossover_rate"], F.lit(0.0)) <= CROSSOVER
    return result(pfs.isNotNull() & os.isNotNull() & better & harm & few, F.when(ratio >= OS_HARM_HIGH, "H").otherwise("M"))


SUBGROUPS = "array<struct<name:string,p:double,adjusted:boolean,pre_specified_interaction:boolean>>"


def programme_heaps(cards: DataFrame, by: str = "sponsor_id", p: Column | None = None) -> DataFrame:
    """Counts of p-values left and right of 0.05 per programme; aggregated before the shuffle."""
    p = F.col("card.primary_result.ITT.p") if p is None else p
    return cards.groupBy(by).agg(F.count_if((p >= HEAP[0]) & (p < CUSP[1])).alias("heap_left"), F.count_if((p >= CUSP[1]) & (p <= HEAP[1])).alias("heap_right"))


def class_thresholds(cards: DataFrame, by: str = "class_id", effect: Column | None = None, won: Column | None = None, graveyard_rate: float = 0.5) -> DataFrame:
    """Exact 75th and 90th percentiles of winners' effects per class, and whether most of the class failed."""
    effect = F.col("card.primary_result.effect_size") if effect is None else effect
    won = below(F.col("card.primary_result.ITT.p"), 0.05) if won is None else won
    return cards.groupBy(by).agg(
        F.percentile(F.when(won, effect), 0.75).alias("p75"),
        F.percentile(F.when(won, effect), 0.90).alias("p90"),
        (F.count_if(~won) > graveyard_rate * F.count("*")).alias("graveyard"),
    )


def evaluate(cards: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """All signals of all cards (trial_id, sponsor_id, class_id, card): columns S1 to S9.

    Signals of the card alone come first and once, so that what is shuffled is signals, not cards, and only
    those that are asked for; then versions join on the trial, by which cards are often dealt out already.
    Class and programme tables are aggregates of the cards and far smaller; they join back on their key.
    """
    heaps, classes = programme_heaps(cards), class_thresholds(cards)
    c = F.col("card")
    alone = {"S2": s2(c), "S3": s3(c), "S4": s4(c), "S6": s6(c), "S7": s7(c), "S9": s9(c)}
    # flat, as Spark leaves out unused columns before a join, but not unused fields
    flat = [s[f].alias(f"_{n}_{f}") for n, s in alone.items() for f in FIELDS]
    wide = cards.select("trial_id", "sponsor_id", "class_id", "card", c["primary_result"]["ITT"]["p"].alias("_p"), c["primary_result"]["effect_size"].alias("_effect"), *flat)
    fired, severity = F.lit(False), F.lit("L")
    if versions is not None:
        wide = wide.join(s1(versions).select("trial_id", F.col("fired").alias("_fired"), F.col("severity").alias("_severity")), "trial_id", "left")
        fired, severity = F.coalesce("_fired", fired), F.coalesce("_severity", severity)
    tails = heaps.select("sponsor_id", heap_tail(F.col("heap_left"), F.col("heap_right")).alias("_tail"))
    wide = wide.join(tails, "sponsor_id", "left").join(classes, "class_id", "left")
    # what S5 and S8 read of a card, under its own names
    part = F.struct(F.struct(F.struct(F.col("_p").alias("p")).alias("ITT"), F.col("_effect").alias("effect_size")).alias("primary_result"))
    out = {n: F.struct(*(F.col(f"_{n}_{f}").alias(f) for f in FIELDS)) for n in alone}
    out |= {"S1": result(fired, severity), "S5": s5(part, F.col("graveyard"), F.col("p75"), F.col("p90")), "S8": s8(part, tail=F.col("_tail"))}
    return wide.select("trial_id", "sponsor_id", "class_id", "card", *(out[n].alias(n) for n in NAMES))


NAMES = tuple(f"S{i}" for i in range(1, 10))
FIELDS = ("fired", "severity", "value", "reason", "low_cert")


def fired_only(signals: DataFrame, high: bool = False) -> DataFrame:
    """Long form of the signals that fired (or only those of severity H): trial_id, S_id, severity, value."""
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("S_id"), F.col(n)["fired"].alias("fired"), F.col(n)["severity"].alias("severity"), F.col(n)["value"].alias("value")) for n in NAMES)))
    out = signals.select("trial_id", rows.alias("r")).where("r.fired").select("trial_id", "r.S_id", "r.severity", "r.value")
    return out.where("severity = 'H'") if high else out


def fired_counts(signals: DataFrame) -> DataFrame:
    """S_id, n of the signals that fired at all: counted where they are, without a row for each."""
    one = signals.agg(*(F.count_if(F.col(n)["fired"]).alias(n) for n in NAMES))
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("S_id"), F.col(n).alias("n")) for n in NAMES)))
    return one.select(rows.alias("r")).select("r.S_id", "r.n").where("n > 0")
