"""Queries over signals, gates, scores, calibration, versions and ranking, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators import calibration, catalyst, gates, scoring, signals, versions
from lodestar.plans import adapters as A
from lodestar.plans.sqltext import CLASSES, CUSP, GAP, GATES, HEAPS, POWER, S1, S3, S4, S6, S6A, S7, S9, SCORES, SIGNALS, WITH_CARDS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _signal(spark, sf_dir: str, column, value: bool = False) -> DataFrame:
    out = A.cards(spark, sf_dir).select("trial_id", column.alias("s"))
    cols = ["trial_id", F.col("s.fired").alias("fired"), F.col("s.severity").alias("severity")]
    return out.select(*cols, *([F.round("s.value", 6).alias("value")] if value else []))


@query(f"WITH {S1} SELECT trial_id, n_versions, fired, CASE WHEN fired THEN 'H' ELSE 'L' END AS severity FROM s1")
def sg1_endpoint_changed(spark, sf_dir):
    return signals.s1(A.versions(spark, sf_dir)).select("trial_id", "n_versions", "fired", "severity")


@query(f"{WITH_CARDS}, {POWER} SELECT trial_id, fired, severity, low_cert, round(pw, 6) AS value FROM s2")
def sg2_underpowered(spark, sf_dir):
    out = A.cards(spark, sf_dir).select("trial_id", signals.s2(F.col("card")).alias("s"))
    return out.select("trial_id", "s.fired", "s.severity", "s.low_cert", F.round("s.value", 6).alias("value"))


@query(f"{WITH_CARDS} SELECT trial_id, {S3} AS fired, CASE WHEN {S3} THEN CASE WHEN highlights THEN 'H' ELSE 'M' END ELSE 'L' END AS severity FROM c")
def sg3_subgroup_only(spark, sf_dir):
    return _signal(spark, sf_dir, signals.s3(F.col("card")))


@query(f"{WITH_CARDS} SELECT trial_id, {S4} AS fired, CASE WHEN {S4} THEN CASE WHEN {GAP} >= 15e-2 OR subjective THEN 'H' ELSE 'M' END ELSE 'L' END AS severity, round(CASE WHEN {S4} THEN {GAP} END, 6) AS value FROM c")
def sg4_itt_vs_pp(spark, sf_dir):
    return _signal(spark, sf_dir, signals.s4(F.col("card")), True)


@query(f"{WITH_CARDS}, {CLASSES}, x AS (SELECT c.trial_id, effect, p90, coalesce(graveyard AND effect >= p75, false) AS fired FROM c LEFT JOIN cls USING (class_id)) SELECT trial_id, fired, CASE WHEN fired THEN CASE WHEN effect >= p90 THEN 'H' ELSE 'M' END ELSE 'L' END AS severity, round(CASE WHEN fired THEN effect END, 6) AS value FROM x")
def sg5_implausible_effect(spark, sf_dir):
    cards = A.cards(spark, sf_dir)
    wide = cards.join(signals.class_thresholds(cards), "class_id", "left")
    return wide.select("trial_id", signals.s5(F.col("card"), F.col("graveyard"), F.col("p75"), F.col("p90")).alias("s")).select("trial_id", "s.fired", "s.severity", F.round("s.value", 6).alias("value"))


@query(f"{WITH_CARDS} SELECT trial_id, {S6} AS fired, CASE WHEN {S6A} THEN 'H' WHEN {S6} THEN 'M' ELSE 'L' END AS severity FROM c")
def sg6_interims(spark, sf_dir):
    return _signal(spark, sf_dir, signals.s6(F.col("card")))


@query(f"{WITH_CARDS} SELECT trial_id, {S7} AS fired, CASE WHEN {S7} THEN 'H' ELSE 'L' END AS severity FROM c")
def sg7_single_arm(spark, sf_dir):
    return _signal(spark, sf_dir, signals.s7(F.col("card")))


@query(f"{WITH_CARDS}, {HEAPS}, x AS (SELECT trial_id, itt_p, {CUSP} AS cusp, coalesce(heaped AND tail < 1e-2, false) AS heap, tail FROM c LEFT JOIN tails USING (sponsor_id)) SELECT trial_id, cusp OR heap AS fired, CASE WHEN cusp THEN 'M' WHEN heap THEN 'H' ELSE 'L' END AS severity, round(CASE WHEN cusp THEN itt_p WHEN heap THEN tail END, 6) AS value FROM x")
def sg8_cusp_or_heaping(spark, sf_dir):
    cards = A.cards(spark, sf_dir)
    tails = signals.programme_heaps(cards).select("sponsor_id", signals.heap_tail(F.col("heap_left"), F.col("heap_right")).alias("tail"))
    wide = cards.join(tails, "sponsor_id", "left")
    return wide.select("trial_id", signals.s8(F.col("card"), tail=F.col("tail")).alias("s")).select("trial_id", "s.fired", "s.severity", F.round("s.value", 6).alias("value"))


@query(f"{WITH_CARDS}, {HEAPS} SELECT sponsor_id, l AS heap_left, r AS heap_right, round(tail, 5) AS tail FROM tails")
def sg8_programme_tails(spark, sf_dir):
    from lodestar.functions.stats import binomial_upper_tail

    h = signals.programme_heaps(A.cards(spark, sf_dir))
    return h.select("sponsor_id", "heap_left", "heap_right", F.round(binomial_upper_tail(F.col("heap_left"), F.col("heap_left") + F.col("heap_right")), 5).alias("tail"))


@query(f"{WITH_CARDS} SELECT trial_id, {S9} AS fired, CASE WHEN {S9} THEN CASE WHEN os_hr >= 12e-1 THEN 'H' ELSE 'M' END ELSE 'L' END AS severity FROM c")
def sg9_os_pfs(spark, sf_dir):
    return _signal(spark, sf_dir, signals.s9(F.col("card")))


def _signals(spark, sf_dir) -> DataFrame:
    return signals.evaluate(A.cards(spark, sf_dir), A.versions(spark, sf_dir))


def _gated(spark, sf_dir) -> DataFrame:
    return gates.evaluate(_signals(spark, sf_dir))


def _scored(spark, sf_dir) -> DataFrame:
    trials = A.trials(spark, sf_dir).withColumnRenamed("is_pivotal", "pivotal_trial")
    wide = _gated(spark, sf_dir).drop("card").join(trials, "trial_id")
    return scoring.score(wide, F.col("pivotal_trial"), F.col("indication"), F.col("phase"))


@query(f"{WITH_CARDS}, {SIGNALS} SELECT S_id, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN f1 THEN 'S1' END, CASE WHEN f2 THEN 'S2' END, CASE WHEN f3 THEN 'S3' END, CASE WHEN f4 THEN 'S4' END, CASE WHEN f5 THEN 'S5' END, CASE WHEN f6 THEN 'S6' END, CASE WHEN f7 THEN 'S7' END, CASE WHEN f8 THEN 'S8' END, CASE WHEN f9 THEN 'S9' END], lambda x: x IS NOT NULL)) AS S_id FROM sig) q GROUP BY 1")
def sga_fired_signals(spark, sf_dir):
    return signals.fired_counts(_signals(spark, sf_dir))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES} SELECT trial_id, g1, g2, g3, g4, round(CASE WHEN g1 THEN 35e-1 ELSE 1e0 END * CASE WHEN g2 THEN 3e0 ELSE 1e0 END * CASE WHEN g3 THEN 42e-1 ELSE 1e0 END * CASE WHEN g4 THEN 25e-1 ELSE 1e0 END, 6) AS lr_product FROM gat")
def gt_gates(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return g.select("trial_id", *(F.col(x)["fired"].alias(x.lower()) for x in gates.GATES), F.round(gates.ratio_product(), 6).alias("lr_product"))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES} SELECT trial_id, CASE WHEN g1 THEN greatest(CASE v1 WHEN 'H' THEN 5e0 WHEN 'M' THEN 35e-1 ELSE 2e0 END, CASE v2 WHEN 'H' THEN 5e0 WHEN 'M' THEN 35e-1 ELSE 2e0 END) ELSE 1e0 END AS lr FROM gat")
def gt0_ratio_by_severity(spark, sf_dir):
    return gates.evaluate(_signals(spark, sf_dir), True).select("trial_id", F.col("G1.lr").alias("lr"))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES}, {SCORES} SELECT trial_id, round(prior_pi, 6) AS prior_pi, round(sum_log_lr, 6) AS sum_log_lr, round(logit_post, 6) AS logit_post, round(p_fail, 6) AS p_fail FROM scored")
def sc2_posterior(spark, sf_dir):
    return _scored(spark, sf_dir).select("trial_id", *(F.round(c, 6).alias(c) for c in ("prior_pi", "sum_log_lr", "logit_post", "p_fail")))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES}, {SCORES} SELECT trial_id, round(CASE WHEN (f1 AND amount % 3 = 0) OR (f4 AND amount % 2 = 0) OR amount % 101 = 0 THEN greatest(p_fail, {0.97!r}::DOUBLE) ELSE p_fail END, 6) AS p_fail, CAST((f1 AND amount % 3 = 0) AS INT) + CAST((f4 AND amount % 2 = 0) AS INT) + CAST(amount % 101 = 0 AS INT) AS n_stops FROM scored")
def sc3_stop_rules(spark, sf_dir):
    trials = A.trials(spark, sf_dir).withColumnRenamed("is_pivotal", "pivotal_trial")
    wide = _gated(spark, sf_dir).drop("card").join(trials, "trial_id")
    flags = (F.col("amount") % 3 == 0, F.col("amount") % 2 == 0, F.col("amount") % 101 == 0)
    return scoring.score(wide, F.col("pivotal_trial"), F.col("indication"), F.col("phase"), flags).select("trial_id", F.round("p_fail", 6).alias("p_fail"), F.size("stops").alias("n_stops"))


@query()
def sc4_audit_trail(spark, sf_dir):
    return _scored(spark, sf_dir).select("trial_id", scoring.audit("run-1").alias("audit"))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES}, {SCORES} SELECT count(*) AS n, round(avg(p_fail), 6) AS mean_p_fail, count(*) FILTER (p_fail > 7e-1) AS high, count(*) FILTER (p_fail > 4e-1 AND p_fail <= 7e-1) AS medium, count(*) FILTER (p_fail <= 4e-1) AS low FROM scored")
def ag9_batch_statistics(spark, sf_dir):
    return scoring.batch_statistics(_scored(spark, sf_dir)).withColumn("mean_p_fail", F.round("mean_p_fail", 6))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES}, {SCORES} SELECT trial_id, round(p_fail, 6) AS p_fail, CASE WHEN p_fail > 7e-1 THEN 'H' WHEN p_fail > 4e-1 THEN 'M' ELSE 'L' END AS band, CASE WHEN p_fail > 7e-1 THEN 'avoid or hedge' WHEN p_fail > 4e-1 THEN 'review by hand' ELSE 'monitor' END AS advice FROM scored")
def sc9_failure_report(spark, sf_dir):
    return scoring.report(_scored(spark, sf_dir)).select("trial_id", F.round("p_fail", 6).alias("p_fail"), "band", "advice")


RANKED = f"""{WITH_CARDS}, {SIGNALS}, {GATES}, {SCORES},
rk0 AS (SELECT trial_id, round(p_fail, 6) AS p_fail, 'T' || CAST(company_id AS VARCHAR) AS ticker, 1e0 + amount % 10 AS score, CAST(amount % 101 AS DOUBLE) AS llm_score, (amount % 100) / 1e2 AS certainty,
  completion - 14 AS window_start, completion + 28 AS window_end FROM scored),
rk1 AS (SELECT *, CASE WHEN score <= 3 THEN 1 WHEN score <= 6 THEN 2 ELSE 3 END AS band, CASE WHEN window_end >= DATE '1998-06-01' THEN greatest(0, date_diff('day', DATE '1998-06-01', window_start + 21)) ELSE 9999 END AS days FROM rk0)"""


def _ranked(spark, sf_dir) -> DataFrame:
    s = _scored(spark, sf_dir)
    rows = s.select("trial_id", F.round("p_fail", 6).alias("p_fail"), F.concat(F.lit("T"), F.col("company_id").cast("string")).alias("ticker"), (1.0 + F.col("amount") % 10).alias("score"), (F.col("amount") % 101).cast("double").alias("llm_score"), (F.col("amount") % 100 / 100.0).alias("certainty"), F.date_sub("completion", 14).alias("window_start"), F.date_add("completion", 28).alias("window_end"))
    return catalyst.ranking(rows, F.lit("1998-06-01").cast("date"))


CONF = """list_filter([CASE WHEN score > 0 THEN least(1e0, score / 10) END, CASE WHEN llm_score > 0 THEN least(1e0, llm_score / 100) END, CASE WHEN certainty > 0 THEN certainty END, CASE WHEN days < 9999 THEN greatest(1e-1, 1 - days / 365e0) END], lambda x: x IS NOT NULL)"""


@query(f"{RANKED}, rk2 AS (SELECT *, {CONF} AS fs, [4e-1, 3e-1, 2e-1, 1e-1] AS ws FROM rk1) SELECT trial_id, band, days, round(list_sum(list_transform(range(1, len(fs) + 1), lambda i: fs[i] * ws[i])) / list_sum(ws[1:len(fs)]), 6) AS confidence, row_number() OVER (ORDER BY band DESC, llm_score DESC, days, certainty DESC, ticker, trial_id) AS position FROM rk2")
def ct8_ranking(spark, sf_dir):
    # only what orders and is told is sorted and written, not all that a trial has
    told = _ranked(spark, sf_dir).select("trial_id", "band", "llm_score", "days", "certainty", "ticker", "confidence")
    out = catalyst.number_rows(told, catalyst.ranking_order())
    return out.select("trial_id", "band", "days", F.round("confidence", 6).alias("confidence"), "position")


@query(f"{RANKED} SELECT count(*) AS trials, count(*) FILTER (band = 1) AS band_1, count(*) FILTER (band = 2) AS band_2, count(*) FILTER (band = 3) AS band_3, round(avg(CASE WHEN days < 9999 THEN days END), 6) AS mean_days FROM rk1")
def ag19_ranking_summary(spark, sf_dir):
    return catalyst.ranking_summary(_ranked(spark, sf_dir)).select("trials", "band_1", "band_2", "band_3", F.round("mean_days", 6).alias("mean_days"))


@query(f"{RANKED} SELECT trial_id, band, days FROM rk1 WHERE score >= 4 AND score <= 9 AND days <= 2000")
def prj6_trial_filter(spark, sf_dir):
    return catalyst.select_trials(_ranked(spark, sf_dir), min_score=4, max_score=9, max_days=2000).select("trial_id", "band", "days")


OUTCOMES = "SELECT o_orderkey AS trial_id, o_orderstatus = 'F' AS success FROM orders WHERE o_orderkey % 4 <> 0"


def _outcomes(spark, sf_dir) -> DataFrame:
    return A.select(spark, sf_dir, OUTCOMES, "orders")


@query(f"{RANKED}, o AS ({OUTCOMES}), n AS (SELECT trial_id, row_number() OVER (ORDER BY band DESC, llm_score DESC, days, certainty DESC, ticker, trial_id) AS position FROM rk1), j AS (SELECT position, NOT coalesce(success, false) AS failed FROM n LEFT JOIN o USING (trial_id)), ks AS (SELECT unnest([1, 3, 5, 10, 50]) AS k) SELECT k, count(*) FILTER (failed) AS failures, count(*) FILTER (failed) / CAST(k AS DOUBLE) AS precision FROM ks JOIN j ON position <= k GROUP BY k")
def bt2_precision_at_k(spark, sf_dir):
    ks = (1, 3, 5, 10, 50)
    top = catalyst.first_rows(_ranked(spark, sf_dir), catalyst.ranking_order(), max(ks)).select("trial_id", "position")
    return catalyst.precision_at(top, _outcomes(spark, sf_dir), ks)


@query(f"{RANKED}, o AS ({OUTCOMES}), j AS (SELECT score, NOT coalesce(success, false) AS failed FROM rk1 LEFT JOIN o USING (trial_id)), a AS (SELECT count(*) FILTER (score >= 7) AS high_risk, count(*) FILTER (score >= 7 AND failed) AS true_positives, (SELECT count(*) FROM o WHERE NOT success) AS total_failures FROM j), b AS (SELECT *, true_positives / CAST(high_risk AS DOUBLE) AS p, true_positives / CAST(total_failures AS DOUBLE) AS r FROM a) SELECT high_risk, true_positives, total_failures, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM b")
def bt3_ranking_accuracy(spark, sf_dir):
    out = catalyst.ranking_accuracy(_ranked(spark, sf_dir), _outcomes(spark, sf_dir))
    return out.select("high_risk", "true_positives", "total_failures", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query(f"{WITH_CARDS}, {SIGNALS}, {GATES}, h AS (SELECT 'G3' AS gate, CASE WHEN trial_id % 2 = 0 THEN 'H' ELSE 'M' END AS severity, trial_id % 3 = 0 AS failed FROM gat WHERE g3 UNION ALL SELECT 'G4', CASE WHEN trial_id % 2 = 0 THEN 'H' ELSE 'M' END, trial_id % 3 = 0 FROM gat WHERE g4), a AS (SELECT gate, severity, count(*) AS n, avg(CAST(failed AS DOUBLE)) AS rate FROM h GROUP BY 1, 2 HAVING count(*) >= 10) SELECT gate, severity, n, round(greatest(1e0, least(1e2, 9e-1 * CASE WHEN rate = 0 THEN 1e-1 ELSE 1e0 END + 1e-1 * CASE gate || severity WHEN 'G3H' THEN 12 WHEN 'G3M' THEN 6 WHEN 'G4H' THEN 20 ELSE 10 END)), 2) AS lr FROM a")
def sc6_ratio_calibration(spark, sf_dir):
    fired = gates.fired_only(_gated(spark, sf_dir), ("G3", "G4"))
    history = fired.select(F.col("G_id").alias("gate"), F.when(F.col("trial_id") % 2 == 0, "H").otherwise("M").alias("severity"), (F.col("trial_id") % 3 == 0).alias("failed"))
    return calibration.gate_ratios(history)


@query(f"WITH t AS ({A.TRIALS}), a AS (SELECT avg(CAST(status = 'F' AS DOUBLE)) AS o FROM t), g AS (SELECT unnest(['pivotal', 'non_pivotal', 'oncology', 'rare_disease', 'phase_2', 'phase_3', 'nobody']) AS category), m AS (SELECT category, count(*) FILTER (hit) AS n, avg(CASE WHEN hit THEN CAST(status = 'F' AS DOUBLE) END) AS r FROM (SELECT category, status, CASE category WHEN 'pivotal' THEN is_pivotal WHEN 'non_pivotal' THEN NOT is_pivotal WHEN 'oncology' THEN indication = 'oncology' WHEN 'rare_disease' THEN indication = 'rare_disease' WHEN 'phase_2' THEN phase = 'phase_2' WHEN 'phase_3' THEN phase = 'phase_3' ELSE false END AS hit FROM g, t) x GROUP BY 1) SELECT category, n, round(8e-1 * CASE WHEN n < 5 THEN o ELSE round(r, 5) END + 2e-1 * o, 4) AS prior FROM m, a")
def sc7_prior_calibration(spark, sf_dir):
    t = A.trials(spark, sf_dir)
    c = {"pivotal": F.col("is_pivotal"), "non_pivotal": ~F.col("is_pivotal"), "oncology": F.col("indication") == "oncology", "rare_disease": F.col("indication") == "rare_disease", "phase_2": F.col("phase") == "phase_2", "phase_3": F.col("phase") == "phase_3", "nobody": F.lit(False)}
    return calibration.category_priors(t, F.col("status") == "F", c).withColumn("prior", F.round("prior", 4))


CONFUSED = f"{RANKED}, o AS ({OUTCOMES}), j AS (SELECT p_fail > 2e-1 AS pred, NOT success AS act, p_fail, trial_id FROM rk1 JOIN o USING (trial_id))"


def _judged(spark, sf_dir) -> DataFrame:
    return _ranked(spark, sf_dir).join(_outcomes(spark, sf_dir), "trial_id").select("trial_id", "p_fail", (F.col("p_fail") > 0.2).alias("pred"), (~F.col("success")).alias("act"))


@query(f"{CONFUSED}, k AS (SELECT count(*) FILTER (pred AND act) AS tp, count(*) FILTER (pred AND NOT act) AS fp, count(*) FILTER (NOT pred AND act) AS fn, count(*) FILTER (NOT pred AND NOT act) AS tn FROM j) SELECT tp, fp, fn, tn, round(coalesce((tp + tn) / nullif(CAST(tp + fp + fn + tn AS DOUBLE), 0), 0), 6) AS accuracy, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision, round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1, round(coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0), 6) AS specificity FROM k")
def ag20_confusion(spark, sf_dir):
    out = calibration.confusion(_judged(spark, sf_dir), F.col("pred"), F.col("act"))
    return out.select("tp", "fp", "fn", "tn", *(F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "specificity")))


@query(f"{CONFUSED}, g AS (SELECT p_fail, count(*) FILTER (act) AS p, count(*) FILTER (NOT act) AS n FROM j GROUP BY 1), w AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY p_fail ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) SELECT round(sum(p * (below + n / 2e0)) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS auc FROM w")
def ag21_auc(spark, sf_dir):
    return calibration.auc(_judged(spark, sf_dir), F.col("p_fail"), F.col("act")).select(F.round("auc", 6).alias("auc"))


@query(f"{CONFUSED}, f AS (SELECT trial_id % 5 AS fold, count(*) AS n, avg(CAST(pred = act AS DOUBLE)) AS a FROM j GROUP BY 1) SELECT fold, n, round(a, 6) AS accuracy, round(avg(a) OVER (), 6) AS mean_accuracy, round(stddev_pop(a) OVER (), 6) AS std_accuracy FROM f")
def ag22_cross_validation(spark, sf_dir):
    out = calibration.fold_metrics(_judged(spark, sf_dir), "trial_id", F.col("pred"), F.col("act"))
    return out.select("fold", "n", *(F.round(c, 6).alias(c) for c in ("accuracy", "mean_accuracy", "std_accuracy")))


WINDOWS = f"""WITH t AS ({A.TRIALS}), h AS (SELECT l_orderkey AS trial_id, min(CAST(l_shipdate AS DATE)) AS s, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1),
sl AS (SELECT c_custkey AS company_id, CAST(floor(c_acctbal / 50) AS INT) AS m, CAST(c_custkey % 20 AS INT) AS p10, CAST(c_custkey % 20 + c_custkey % 60 AS INT) AS p90 FROM customer WHERE c_custkey % 5 <> 0),
b AS (SELECT t.trial_id, t.company_id, t.completion, t.status, t.amount, CAST(greatest(-30, least(75, coalesce(m, 0))) AS INT) AS sh, CAST(least(14, greatest(0, floor((coalesce(p90, 0) - coalesce(p10, 0)) / 2e0))) AS INT) AS pad, h.s, h.n FROM t LEFT JOIN sl USING (company_id) LEFT JOIN h USING (trial_id)),
w AS (SELECT *, completion - 14 + sh - pad AS s1, completion + 28 + sh + pad AS e1, 4e-1 * least(1e0, 5e-1 + 5e-1 * exp(-(amount % 400) / 18e1)) AS w1, s + sh - pad AS s2, s + 30 + sh + pad AS e2, (3e-1 + n % 7 / 1e1) * least(1e0, 5e-1 + 5e-1 * exp(-30 / 18e1)) AS w2 FROM b),
f AS (SELECT *, s2 IS NULL AS one, greatest(s1, s2) <= least(e1, e2) AS meets, CASE WHEN w2 > w1 THEN w2 ELSE w1 END AS best FROM w),
q AS (SELECT *, CASE WHEN one THEN s1 WHEN meets THEN greatest(s1, s2) ELSE least(s1, s2) END AS ws, CASE WHEN one THEN e1 WHEN meets THEN least(e1, e2) ELSE greatest(e1, e2) END AS we, CASE WHEN one OR meets THEN 3e1 ELSE 45e0 END AS sc FROM f)
SELECT trial_id, CASE WHEN status = 'F' AND amount % 2 = 0 THEN completion ELSE ws END AS window_start, CASE WHEN status = 'F' AND amount % 2 = 0 THEN completion ELSE we END AS window_end, round(CASE WHEN status = 'F' AND amount % 2 = 0 THEN 1e0 ELSE greatest(0e0, least(1e0, 1 - date_diff('day', ws, we) / sc * (1 - best))) END, 6) AS certainty FROM q"""


@query(WINDOWS)
def ct6_catalyst_windows(spark, sf_dir):
    t = A.trials(spark, sf_dir).select("trial_id", "company_id", "completion", (F.col("amount") % 400).alias("age_days"), F.when(F.col("status") == "F", "Completed").otherwise("Open").alias("status"), F.when(F.col("amount") % 2 == 0, F.col("completion")).alias("event_date"))
    t = t.withColumn("event_date", F.when(F.col("status") == "Completed", F.col("event_date")))
    lines = A.tables(spark, sf_dir, "lineitem", "customer")
    hints = lines["lineitem"].where("l_orderkey % 3 <> 0").groupBy(F.col("l_orderkey").alias("trial_id")).agg(F.min(F.col("l_shipdate").cast("date")).alias("start"), F.count("*").alias("n"))
    hints = hints.select("trial_id", "start", F.date_add("start", 30).alias("end"), (0.3 + F.col("n") % 7 / 10.0).alias("weight"))
    slips = lines["customer"].where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("company_id"), F.floor(F.col("c_acctbal") / 50).cast("int").alias("mean_slip_days"), (F.col("c_custkey") % 20).cast("int").alias("p10_days"), (F.col("c_custkey") % 20 + F.col("c_custkey") % 60).cast("int").alias("p90_days"))
    return catalyst.infer(t, hints, slips).select("trial_id", "window_start", "window_end", F.round("certainty", 6).alias("certainty"))


@query(f"""{WITH_CARDS}, t AS ({A.TRIALS}), s AS (SELECT trial_id, itt_p AS p_fail FROM c), l AS (SELECT l_orderkey AS trial_id, l_linenumber AS score, l_linenumber % 3 = 0 AS fired, 'G' || CAST(1 + l_linenumber % 4 AS VARCHAR) AS g FROM lineitem),
k AS (SELECT trial_id, avg(score) AS mean_score FROM l GROUP BY 1), m AS (SELECT trial_id, score AS base_score, avg(score * 10e0) AS llm FROM l GROUP BY 1, 2), gg AS (SELECT trial_id, array_to_string(list_sort(list(DISTINCT g)), ',') AS gates FROM l WHERE fired GROUP BY 1)
SELECT t.trial_id, t.phase, round(coalesce(s.p_fail, 0), 6) AS p_fail, round(coalesce(k.mean_score, 0), 6) AS card_score, round(coalesce(m.llm, 0), 6) AS llm_score, coalesce(gg.gates, '') AS gates
FROM t LEFT JOIN s USING (trial_id) LEFT JOIN k USING (trial_id) LEFT JOIN m ON m.trial_id = t.trial_id AND m.base_score = CAST(round(k.mean_score) AS INT) LEFT JOIN gg ON gg.trial_id = t.trial_id WHERE t.is_pivotal""")
def ct9_dashboard(spark, sf_dir):
    line = A.tables(spark, sf_dir, "lineitem")["lineitem"].select(F.col("l_orderkey").alias("trial_id"), F.col("l_linenumber").alias("score"))
    scores = A.cards(spark, sf_dir).select("trial_id", F.lit(1).alias("run_id"), F.col("card.primary_result.ITT.p").alias("p_fail"))
    windows = A.trials(spark, sf_dir).select("trial_id", F.col("completion").alias("window_start"), F.col("completion").alias("window_end"), F.lit(0.5).alias("certainty"))
    llm = line.select("trial_id", F.col("score").alias("base_score"), (F.col("score") * 10.0).alias("expanded"))
    fired = line.select("trial_id", F.concat(F.lit("G"), (1 + F.col("score") % 4).cast("string")).alias("G_id"), (F.col("score") % 3 == 0).alias("fired"))
    out = catalyst.dashboard(A.trials(spark, sf_dir), scores, windows, line, llm, fired)
    return out.select("trial_id", "phase", *(F.round(c, 6).alias(c) for c in ("p_fail", "card_score", "llm_score")), F.array_join("gates", ",").alias("gates"))


CHANGED = f"""WITH v AS ({A.VERSIONS}), p AS (SELECT *, lag(sample_size) OVER w AS ws, lag(endpoint) OVER w AS we, row_number() OVER w AS n FROM v WINDOW w AS (PARTITION BY trial_id ORDER BY captured_at, version_id)),
d AS (SELECT *, CASE WHEN n > 1 AND sample_size <> ws AND ws <> 0 THEN abs(sample_size - ws) / CAST(ws AS DOUBLE) END AS ratio, n > 1 AND endpoint IS DISTINCT FROM we AS ep, n > 1 AND sample_size IS DISTINCT FROM ws AS sz FROM p)"""


def _changes(spark, sf_dir) -> DataFrame:
    pv = versions.with_previous(A.versions(spark, sf_dir), "trial_id", ["captured_at", "version_id"], ["sample_size", "endpoint"])
    later = F.col("n") > 1
    changes = F.array_compact(F.array(F.when(later, versions.change("primary_endpoint_text", F.col("was_endpoint"), F.col("endpoint"))), F.when(later, versions.change("sample_size", F.col("was_sample_size"), F.col("sample_size"), "number"))))
    return pv.withColumn("changes", changes)


@query(f"{CHANGED} SELECT version_id, CAST(ep AS INT) + CAST(sz AS INT) AS n_changes, CASE WHEN ep OR sz THEN 1e0 ELSE 0e0 END AS change_score FROM d")
def ch5_change_score(spark, sf_dir):
    return _changes(spark, sf_dir).select("version_id", F.size("changes").alias("n_changes"), F.round(versions.change_score(F.col("changes")), 6).alias("change_score"))


@query(f"{CHANGED}, g AS (SELECT trial_id, count(*) AS versions, CAST(sum(CAST(ep AS INT) + CAST(sz AS INT)) AS BIGINT) AS material_changes, greatest(1, CAST(floor((epoch_us(max(captured_at)) - epoch_us(min(captured_at))) / 864e8) AS BIGINT)) AS days FROM d GROUP BY 1), r AS (SELECT *, (versions - 1) / CAST(days AS DOUBLE) * 365 AS rate FROM g) SELECT trial_id, versions, round(rate, 6) AS changes_a_year, material_changes, CASE WHEN material_changes >= 5 OR rate > 12 THEN 'H' WHEN material_changes >= 2 OR rate > 6 THEN 'M' ELSE 'L' END AS risk FROM r")
def ch7_change_summary(spark, sf_dir):
    out = versions.summary(_changes(spark, sf_dir), "trial_id", "captured_at", F.size(F.filter("changes", lambda c: c["material"])))
    return out.withColumn("changes_a_year", F.round("changes_a_year", 6))


@query(f"{CHANGED}, k AS (SELECT *, row_number() OVER (PARTITION BY trial_id ORDER BY captured_at DESC, version_id DESC) AS rr FROM d) SELECT trial_id, version_id, CASE WHEN ratio > 2e-1 THEN 'H' ELSE 'M' END AS severity, round(ratio, 6) AS ratio FROM k WHERE rr = 1 AND ratio IS NOT NULL")
def ch4_sample_size_change(spark, sf_dir):
    two = versions.last_two(A.versions(spark, sf_dir), "trial_id", ["captured_at", "version_id"])
    pv = versions.with_previous(two, "trial_id", ["captured_at", "version_id"], ["sample_size"]).where("n = 2 and sample_size <> was_sample_size")
    ratio = versions.relative_change(F.col("was_sample_size"), F.col("sample_size"))
    return pv.select("trial_id", "version_id", F.when(ratio > versions.SIZE_CHANGE, "H").otherwise("M").alias("severity"), F.round(ratio, 6).alias("ratio")).where("ratio is not null")


@query(f"WITH v AS ({A.VERSIONS}), p AS (SELECT *, lag(props) OVER (PARTITION BY trial_id ORDER BY captured_at, version_id) AS was FROM v) SELECT version_id, json_extract_string(was, '$.k') AS old, json_extract_string(props, '$.k') AS new FROM p WHERE was IS NOT NULL AND json_extract_string(was, '$.k') IS DISTINCT FROM json_extract_string(props, '$.k')")
def ch1_json_diff(spark, sf_dir):
    pv = versions.with_previous(A.versions(spark, sf_dir), "trial_id", ["captured_at", "version_id"], ["props"]).where("n > 1")
    return pv.select("version_id", F.explode(versions.json_diff(F.col("was_props"), F.col("props"))).alias("d")).select("version_id", F.col("d.old").alias("old"), F.col("d.new").alias("new"))


@query(f"WITH v AS ({A.VERSIONS}) SELECT trial_id, arg_max(version_id, (captured_at, version_id)) AS version_id, count(*) AS n FROM v GROUP BY 1")
def jn13_latest_version(spark, sf_dir):
    v = A.versions(spark, sf_dir)
    return v.groupBy("trial_id").agg(F.max_by("version_id", F.struct("captured_at", "version_id")).alias("version_id"), F.count("*").alias("n"))


def flagship(spark, sf_dir) -> DataFrame:
    """Trials by failure probability, ranked, with what drives it."""
    s = _scored(spark, sf_dir)
    return scoring.report(s).orderBy(F.desc("p_fail"), "trial_id").limit(100)
