"""Readout windows, ranking and back-tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.durable import kept

# The base window, slip clamps, decay of old hints, scales of certainty, ranking weights.
BASE_DAYS, BASE_WEIGHT, HINT_AGE = (14, 28), 0.4, 30
SHIFT, WIDEN = (-30, 75), 14
CERTAINTY_DAYS = {"overlap": 30.0, "apart": 45.0}
CONFIDENCE_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
PAST = 9999


def slip(window: Column, mean: Column, p10: Column, p90: Column) -> Column:
    """A window moved by the sponsor's mean slip and widened by half its spread, both clamped."""
    shift = F.greatest(F.lit(SHIFT[0]), F.least(F.lit(SHIFT[1]), F.coalesce(mean, F.lit(0)))).cast("int")
    pad = F.least(F.lit(WIDEN), F.greatest(F.lit(0), F.floor((F.coalesce(p90, F.lit(0)) - F.coalesce(p10, F.lit(0))) / 2))).cast("int")
    return F.struct(F.date_add(window["start"], shift - pad).alias("start"), F.date_add(window["end"], shift + pad).alias("end"), window["weight"].alias("weight"))


def aged(weight: Column, days: Column) -> Column:
    return weight * F.least(F.lit(1.0), 0.5 + 0.5 * F.exp(-days / F.lit(180.0)))


def base_window(completion: Column, age_days: Column) -> Column:
    return F.struct(F.date_sub(completion, BASE_DAYS[0]).alias("start"), F.date_add(completion, BASE_DAYS[1]).alias("end"), aged(F.lit(BASE_WEIGHT), age_days).alias("weight"))


def fuse(windows: Column) -> Column:
    """One window from an array of (start, end, weight), the two heaviest: what they share, else all that
    they span.  Of equal weights the one that comes first in the array."""
    numbered = F.transform(windows, lambda w, i: F.struct((-w["weight"]).alias("k"), i.alias("i"), w["start"].alias("start"), w["end"].alias("end"), w["weight"].alias("weight")))

    def of(pair: Column) -> Column:
        a, b = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
        one = F.size(pair) == 1
        start, end = F.greatest(a["start"], b["start"]), F.least(a["end"], b["end"])
        meets = one | (start <= end)
        s = F.when(meets, start).otherwise(F.least(a["start"], b["start"]))
        e = F.when(meets, end).otherwise(F.greatest(a["end"], b["end"]))
        scale = F.when(meets, CERTAINTY_DAYS["overlap"]).otherwise(CERTAINTY_DAYS["apart"])
        certainty = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.datediff(e, s) / scale * (1 - a["weight"])))
        return F.struct(s.alias("window_start"), e.alias("window_end"), certainty.alias("certainty"))

    # bound to a name by a transform over one element: an expression's text would be evaluated at each mention
    return F.get(F.transform(F.array(F.slice(F.array_sort(numbered), 1, 2)), of), F.lit(0))


def infer(trials: DataFrame, hints: DataFrame, slips: DataFrame) -> DataFrame:
    """Windows of trials(trial_id, company_id, completion, age_days, status, event_date).

    hints(trial_id, start, end, weight), slips(company_id, mean_slip_days, p10_days, p90_days).  A
    finished trial with a known date has that day, for certain.
    """
    stats = (F.col("mean_slip_days"), F.col("p10_days"), F.col("p90_days"))
    held = hints.groupBy("trial_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "weight"))).alias("h"))
    one = trials.join(held, "trial_id", "left").join(slips, "company_id", "left")
    none = F.array().cast("array<struct<start:date,end:date,weight:double>>")
    moved = F.transform(F.coalesce("h", none), lambda w: slip(F.struct(w["start"].alias("start"), w["end"].alias("end"), aged(w["weight"], F.lit(HINT_AGE)).alias("weight")), *stats))
    base = F.array(slip(base_window(F.col("completion"), F.col("age_days")), *stats))
    done = F.col("status").isin("Completed", "Terminated") & F.col("event_date").isNotNull()
    exact = F.struct(F.col("event_date").alias("window_start"), F.col("event_date").alias("window_end"), F.lit(1.0).alias("certainty"))
    return one.select("trial_id", "company_id", F.when(done, exact).otherwise(fuse(F.concat(base, moved))).alias("w")).select("trial_id", "company_id", "w.*")


def proximity(start: Column, end: Column, today: Column) -> Column:
    """Days to the middle of the window; 9999 for one that is past or missing."""
    middle = F.date_add(start, F.floor(F.datediff(end, start) / 2).cast("int"))
    return F.coalesce(F.when(end >= today, F.greatest(F.lit(0), F.datediff(middle, today))), F.lit(PAST))


def band(score: Column) -> Column:
    return F.when(score <= 3, 1).when(score <= 6, 2).otherwise(3)


def confidence(score: Column, llm: Column, certainty: Column, days: Column) -> Column:
    """Weighted mean of the factors that are there, the first having the largest weight."""
    factors = F.array_compact(F.array(F.when(score > 0, F.least(F.lit(1.0), score / 10)), F.when(llm > 0, F.least(F.lit(1.0), llm / 100)), F.when(certainty > 0, certainty), F.when(days < PAST, F.greatest(F.lit(0.1), 1 - days / F.lit(365.0)))))
    weights = F.slice(F.array(*(F.lit(w) for w in CONFIDENCE_WEIGHTS)), F.lit(1), F.size(factors))
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    hit = F.aggregate(F.zip_with(factors, weights, lambda f, w: f * w), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(factors) == 0, 0.5).otherwise(hit / total)


def ranking(trials: DataFrame, today: Column) -> DataFrame:
    """trials(trial_id, ticker, score, llm_score, certainty, window_start, window_end) with band, days and
    confidence.  Order it with `ranking_order`; that is a range sort, not one task's work."""
    days = proximity(F.col("window_start"), F.col("window_end"), today)
    one = trials.withColumn("days", days).withColumn("band", band(F.col("score")))
    return one.withColumn("confidence", confidence(F.col("score"), F.col("llm_score"), F.col("certainty"), F.col("days")))


def ranking_order() -> list[Column]:
    return [F.desc("band"), F.desc("llm_score"), F.asc("days"), F.desc("certainty"), F.asc("ticker"), F.asc("trial_id")]


def number_rows(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Positions 1, 2, ... in a global order: rows are sorted by range once and written with their place in their
    range; the ranges' counts, a row each, give what comes before."""
    place = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    ranged = kept(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", place))
    split = ranged.withColumn("_part", F.shiftright("_id", 33)).withColumn("_n", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_id")
    counts = split.groupBy("_part").count()
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("_before"))
    return split.join(F.broadcast(before), "_part").withColumn(name, F.col("_n") + F.col("_before")).drop("_n", "_part", "_before")


def first_rows(df: DataFrame, order: list[Column], n: int, name: str = "position") -> DataFrame:
    """The first n rows of a global order with their positions 1 to n, as `number_rows` gives them: every task keeps
    its own n first of all rows, so nothing is sorted whole; for an n that one task holds."""
    return df.orderBy(*order).limit(n).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def select_trials(trials: DataFrame, min_score: float | None = None, max_score: float | None = None, min_confidence: float | None = None, max_days: int | None = None, phases: list[str] | None = None, tickers: list[str] | None = None) -> DataFrame:
    """All given conditions at once."""
    for c in (None if min_score is None else F.col("score") >= min_score, None if max_score is None else F.col("score") <= max_score, None if min_confidence is None else F.col("confidence") >= min_confidence, None if max_days is None else F.col("days") <= max_days, None if phases is None else F.col("phase").isin(phases), None if tickers is None else F.col("ticker").isin(tickers)):
        trials = trials if c is None else trials.where(c)
    return trials


def ranking_summary(ranked: DataFrame) -> DataFrame:
    near = F.when(F.col("days") < PAST, F.col("days"))
    return ranked.agg(F.count("*").alias("trials"), *(F.count_if(F.col("band") == b).alias(f"band_{b}") for b in (1, 2, 3)), F.avg("confidence").alias("mean_confidence"), F.coalesce(F.avg(near), F.lit(0.0)).alias("mean_days"))


def precision_at(top: DataFrame, outcomes: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Share of failures among the first k of top(trial_id, position); a trial without outcome failed.

    Only the largest k rows are read; a k beyond the number of rows is left out.
    """
    head = top.where(F.col("position") <= max(ks)).join(outcomes, "trial_id", "left").withColumn("failed", ~F.coalesce("success", F.lit(False)))
    one = head.agg(F.count("*").alias("n"), *(F.count_if((F.col("position") <= k) & F.col("failed")).alias(f"f{k}") for k in ks))
    rows = one.select("n", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"f{k}").alias("failures")) for k in ks))).alias("r"))
    return rows.where("r.k <= n").select("r.k", "r.failures", (F.col("r.failures") / F.col("r.k")).alias("precision"))


def ranking_accuracy(ranked: DataFrame, outcomes: DataFrame, threshold: float = 7.0) -> DataFrame:
    """Precision, recall and F1 of the trials scored at or over the threshold as failures."""
    j = ranked.select("trial_id", "score").join(outcomes, "trial_id", "left")
    failed = ~F.coalesce("success", F.lit(False))
    counts = j.where(F.col("score") >= threshold).agg(F.count("*").alias("high_risk"), F.count_if(failed).alias("true_positives"))
    known = outcomes.agg(F.count_if(~F.col("success")).alias("total_failures"))
    both = counts.join(F.broadcast(known))  # one row each
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    p, r = rate(F.col("true_positives"), F.col("high_risk")), rate(F.col("true_positives"), F.col("total_failures"))
    return both.select("*", p.alias("precision"), r.alias("recall"), rate(2 * p * r, p + r).alias("f1"))


def dashboard(trials: DataFrame, scores: DataFrame, windows: DataFrame, card_ranks: DataFrame, llm: DataFrame, gates: DataFrame) -> DataFrame:
    """Pivotal trials with their latest score, window, mean card score, language-model score in the band of
    that mean (rounded, not cut), and the gates that fired.  Right sides are aggregated first, one row
    per trial, so no join multiplies rows."""
    latest = scores.groupBy("trial_id").agg(F.max_by("p_fail", "run_id").alias("p_fail"))
    cards = card_ranks.groupBy("trial_id").agg(F.avg("score").alias("mean_score"))
    bands = llm.groupBy("trial_id", "base_score").agg(F.avg("expanded").alias("llm_score"))
    fired = gates.where("fired").groupBy("trial_id").agg(F.array_sort(F.collect_set("G_id")).alias("gates"))
    out = trials.where("is_pivotal").join(latest, "trial_id", "left").join(windows, "trial_id", "left").join(cards, "trial_id", "left")
    out = out.withColumn("base_score", F.round("mean_score").cast("int")).join(bands, ["trial_id", "base_score"], "left").join(fired, "trial_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return out.select("trial_id", "phase", "window_start", "window_end", "certainty", zero("p_fail"), F.coalesce("mean_score", F.lit(0.0)).alias("card_score"), zero("llm_score"), F.coalesce("gates", F.array().cast("array<string>")).alias("gates"))
