"""Operator inputs derived from the driver's tables.

Each adapter is one SQL text that Spark and DuckDB read alike, so a query and its oracle start from the
same rows.  Numbers come from whole-number remainders, never from sums of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One flat card per order; (l_orderkey, l_linenumber) isn't unique, so lines are aggregated first.
CARDS = """
SELECT trial_id, sponsor_id, class_id, pmax % 3 <> 0 AS is_pivotal,
  CASE WHEN pmin % 4 = 0 THEN 'tte' WHEN pmin % 4 = 3 THEN 'other' ELSE 'proportion' END AS primary_type,
  pmax % 5 = 0 AS single_arm, 10 + 4 * qmax AS n_t, 10 + 4 * qmin AS n_c, (pmax % 30) / 1e2 AS drop_t, (pmin % 30) / 1e2 AS drop_c,
  pmax % 2 = 0 AS one_sided, CASE WHEN pmin % 3 = 1 THEN 25e-3 WHEN pmin % 3 = 2 THEN 5e-2 END AS alpha,
  CASE WHEN pmin % 7 <> 0 THEN 1e-1 + (pmax % 40) / 1e2 END AS p_c, CASE WHEN pmax % 11 <> 0 THEN 3e-1 END AS hist_rate,
  CASE WHEN pmax % 6 <> 0 THEN 5e-2 + (pmin % 25) / 1e2 END AS delta, CASE WHEN pmax % 12 = 0 THEN 1e-1 END AS mcid,
  CASE WHEN pmin % 13 <> 0 THEN 5e-1 + (pmax % 60) / 1e2 END AS hr_alt, CASE WHEN pmax % 8 <> 0 THEN 20 + pmin % 400 END AS planned_events,
  CASE WHEN pmax % 16 <> 0 THEN 15 + pmin % 300 END AS events_observed, 20 + 4 * (qmax + qmin) AS n_total,
  (pmax % 1000) / 1e4 AS itt_p, (pmin % 200 - 60) / 1e2 AS itt_est, CASE WHEN pmin % 17 <> 0 THEN (pmin % 1000) / 1e4 END AS pp_p,
  (pmax % 200 - 40) / 1e2 AS pp_est, (pmax % 900) / 1e3 AS effect, (pmin % 700) / 5e3 AS sg1_p, pmin % 2 = 0 AS sg1_adj, pmax % 7 = 0 AS sg1_pre,
  (pmax % 900) / 6e3 AS sg2_p, pmax % 3 = 0 AS sg2_adj, pmin % 5 = 0 AS highlights, pmax % 9 = 0 AS subjective,
  pmin % 4 AS interims, CASE WHEN pmax % 3 = 0 THEN 'obf' END AS spending, pmax % 5 AS peeks, pmin % 6 = 0 AS realloc,
  CASE WHEN pmax % 19 <> 0 THEN 5e-1 + (pmin % 80) / 1e2 END AS pfs_hr, (pmax % 400) / 1e3 AS pfs_p, 7e-1 + (pmax % 60) / 1e2 AS pfs_ci,
  8e-1 + (pmax % 60) / 1e2 AS os_hr, (pmin % 400) / 1e3 AS os_p, 4e-1 + (pmax % 60) / 1e2 AS os_frac, (pmin % 60) / 1e2 AS xover
FROM (SELECT l_orderkey AS trial_id, min(l_suppkey) AS sponsor_id, min(l_partkey) % 25 AS class_id,
    CAST(floor(max(l_extendedprice)) AS BIGINT) AS pmax, CAST(floor(min(l_extendedprice)) AS BIGINT) AS pmin,
    CAST(floor(max(l_quantity)) AS BIGINT) AS qmax, CAST(floor(min(l_quantity)) AS BIGINT) AS qmin
  FROM lineitem GROUP BY l_orderkey) x
"""

#: Registry versions: a user's events in time order.
VERSIONS = """
SELECT user_id AS trial_id, event_id AS version_id, ts AS captured_at,
  CASE event_type WHEN 'purchase' THEN 'Overall survival at 24 months' WHEN 'view' THEN 'Progression-free survival, 12 months, blinded'
    WHEN 'click' THEN 'Objective response rate' WHEN 'signup' THEN 'Non-inferior dose, open-label' ELSE NULL END AS endpoint,
  CASE WHEN event_id % 2 = 0 THEN DATE '2024-05-30' ELSE DATE '2024-12-31' END AS completion,
  CAST(floor(value) AS BIGINT) AS sample_size, props
FROM events
"""

#: What is known of trials besides their cards.
TRIALS = """
SELECT o_orderkey AS trial_id, o_custkey AS company_id, o_orderstatus <> 'P' AS is_pivotal,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'oncology' WHEN 'BUILDING' THEN 'rare_disease' ELSE 'general' END AS indication,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'phase_3' WHEN o_orderpriority LIKE '2%' THEN 'phase_1' ELSE 'phase_2' END AS phase,
  CAST(o_orderdate AS DATE) AS completion, CAST(floor(o_totalprice) AS BIGINT) AS amount, o_orderstatus AS status
FROM orders JOIN customer ON o_custkey = c_custkey
"""

CARD_TYPES = {
    "arms": "struct<t:struct<n:bigint,dropout:double>,c:struct<n:bigint,dropout:double>>",
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def select(spark: SparkSession, sf_dir: str, sql: str, *names: str, even: bool = False) -> DataFrame:
    """An adapter's rows; its tables are read lazily and only their used columns.  If `even`, they are spread first."""
    text = sql.replace("{", "{{").replace("}", "}}")  # the formatter's own
    for n in names:
        text = _word(text, n)
    return spark.sql(text, **{n: spread(t) if even else t for n, t in tables(spark, sf_dir, *names).items()})


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores: what is slow by the row would else run in as few tasks as a small file has pieces."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def _word(sql: str, name: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)


def nest() -> Column:
    """The card struct from flat columns."""
    s = lambda **k: F.struct(*(v.alias(n) for n, v in k.items()))
    c = F.col
    some = lambda there, x: F.when(there, x)
    return s(
        is_pivotal=c("is_pivotal"), primary_type=c("primary_type"), single_arm=c("single_arm"), historical_control_rate=c("hist_rate"), mcid_abs=c("mcid"), events_observed=c("events_observed"), N_total=c("n_total"), actual_peeks=c("peeks"),
        narrative_highlights_subgroup=c("highlights"), endpoint_subjective_unblinded=c("subjective"), arms=s(t=s(n=c("n_t"), dropout=c("drop_t")), c=s(n=c("n_c"), dropout=c("drop_c"))),
        analysis_plan=s(alpha=c("alpha"), one_sided=c("one_sided"), two_sided=F.lit(None).cast("boolean"), assumed_p_c=c("p_c"), assumed_delta_abs=c("delta"), hr_alt=c("hr_alt"), planned_events=c("planned_events"), alloc_ratio=F.lit(None).cast("double"), planned_interims=c("interims"), alpha_spending=c("spending"), reallocated_alpha=c("realloc")),
        primary_result=s(ITT=s(p=c("itt_p"), estimate=c("itt_est")), PP=some(c("pp_p").isNotNull(), s(p=c("pp_p"), estimate=c("pp_est"))), effect_size=c("effect")),
        subgroups=F.array(s(name=F.lit("a"), p=c("sg1_p"), adjusted=c("sg1_adj"), pre_specified_interaction=c("sg1_pre")), s(name=F.lit("b"), p=c("sg2_p"), adjusted=c("sg2_adj"), pre_specified_interaction=F.lit(False))),
        pfs=some(c("pfs_hr").isNotNull(), s(hr=c("pfs_hr"), p=c("pfs_p"), ci95_upper=c("pfs_ci"))), os=s(hr=c("os_hr"), p=c("os_p"), events_frac=c("os_frac"), crossover_rate=c("xover")),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trial_id, sponsor_id, class_id, card."""
    return select(spark, sf_dir, CARDS, "lineitem").select("trial_id", "sponsor_id", "class_id", nest().alias("card"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, VERSIONS, "events")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, TRIALS, "orders", "customer")
