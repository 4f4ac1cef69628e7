"""Companies that contain a sponsor's name, rows of scored candidates, and the queue of decisions for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators.resolve import promote_aliases


def _similarity(a: Column, b: Column) -> Column:
    """Trigrams in both over trigrams in either; 0 without any."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(0.0))


def _grams(s: Column, n: Column) -> Column:
    return F.when(F.length(s) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: s.substr(i, n)))).otherwise(F.array().cast("array<string>"))


def containing(sought: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (q, text) of sought(q) and texts(text), in lower case, where the text holds q as it is written.

    A text that holds q holds all its runs of three characters, so they meet on the rarest of these (q itself if it's
    shorter) and are compared then: an equi-join, never every text with every q.  A null or empty q is in none.
    """
    t = texts.select("text").where("text <> ''").distinct()
    held = t.select("text", F.explode(F.concat(*(_grams(F.col("text"), F.lit(n)) for n in (1, 2, 3)))).alias("g"))
    counts = held.groupBy("g").agg(F.count("*").alias("n"))
    own = sought.select("q").where("q <> ''").distinct().select("q", F.explode(_grams(F.col("q"), F.least(F.lit(3), F.length("q")))).alias("g"))
    rarest = own.join(counts, "g").groupBy("q").agg(F.min_by("g", F.struct("n", "g")).alias("g"))
    return rarest.join(held, "g").where(F.contains("text", "q")).select("q", "text")


def containment_candidates(sponsors: DataFrame, companies: DataFrame, aliases: DataFrame, k: int = 50, least: float = 0.3) -> DataFrame:
    """The k best companies of a normalised sponsor name: sponsor, company_id, name, sim_name, alias_prefix_hit, rank.

    A company is met if its name or an alias is similar in trigrams or holds the sponsor's name.  An alias that begins
    with it comes first, then similarity, then the company id.  If the company's name is met all its aliases count, else
    those that are met themselves.
    """
    q = sponsors.select(F.col("sponsor")).where("sponsor <> ''").distinct().select("sponsor", F.lower("sponsor").alias("q"))
    named = companies.select("company_id", "name", F.lower("name").alias("text"))
    called = aliases.select("company_id", F.lower("alias").alias("text"))
    every = named.select("company_id", "text").unionByName(called).where("text is not null").distinct()
    texts = every.select("text").distinct()
    a = q.select("q").distinct().select("q", T.trigrams(F.col("q")).alias("g")).select("q", F.size("g").alias("na"), F.explode("g").alias("t"))
    b = texts.select("text", T.trigrams(F.col("text")).alias("g")).select("text", F.size("g").alias("nb"), F.explode("g").alias("t"))
    shared = a.join(b, "t").groupBy("q", "text", "na", "nb").agg(F.count("*").alias("n"))
    near = shared.where(F.col("n") / (F.col("na") + F.col("nb") - F.col("n")) >= least).select("q", "text")
    met = near.unionByName(containing(q, texts)).distinct().join(every, "text").select("q", "company_id").distinct()
    sim = lambda c: _similarity(T.trigrams(F.col("q")), T.trigrams(F.col(c)))
    rows = met.join(named.withColumnRenamed("text", "_name"), "company_id").join(called.withColumnRenamed("text", "_alias"), "company_id", "left").withColumns({"_sn": sim("_name"), "_sa": sim("_alias")})
    hit = lambda c, s: F.coalesce((F.col(s) >= least) | F.contains(c, "q"), F.lit(False))
    kept = rows.where(hit("_name", "_sn") | hit("_alias", "_sa"))
    best = kept.groupBy("q", "company_id", "name").agg(F.max(F.greatest("_sn", "_sa")).alias("sim_name"), F.coalesce(F.max(F.startswith("_alias", "q").cast("int")), F.lit(0)).alias("alias_prefix_hit"))
    w = Window.partitionBy("sponsor").orderBy(F.desc("alias_prefix_hit"), F.desc("sim_name"), "company_id")
    return q.join(best, "q").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("q")


def candidate_rows(scored: DataFrame, run_id: Column, feature_names: list[str]) -> DataFrame:
    """Rows to append to the table of candidate features: the features as JSON, no score before calibration."""
    return scored.select(
        run_id.alias("run_id"), "nct_id", T.norm_name(F.coalesce(F.col("sponsor"), F.lit(""))).alias("sponsor_text_norm"), "company_id",
        F.to_json(F.struct(*feature_names)).alias("features_jsonb"), F.lit(None).cast("double").alias("score_precal"), F.col("p").alias("p_calibrated"),
    )


def pending(queue: DataFrame, limit: int = 20) -> DataFrame:
    """The oldest open items with the number of their candidates; `limit` is the length of the list shown."""
    return queue.select("rq_id", "run_id", "nct_id", "sponsor", F.when(F.col("candidates").isNotNull(), F.size("candidates")).alias("n_cands"), "created_at").orderBy("created_at", "rq_id").limit(limit)


def accept(queue: DataFrame, choices: DataFrame, aliases: DataFrame, run_id: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions, new aliases, and what stays in the queue, from choices(rq_id, company_id, decided_by).

    An item chosen twice gives one decision, that of the smallest company id.  Choices of unknown items do nothing.
    """
    one = choices.groupBy("rq_id").agg(F.min(F.struct("company_id", "decided_by")).alias("c")).select("rq_id", "c.*")
    taken = queue.join(one, "rq_id")
    decisions = taken.select(
        run_id.alias("run_id"), "nct_id", "sponsor", "company_id", F.lit("accept").alias("mode"), F.lit(1.0).alias("p"), F.lit(1.0).alias("top2_margin"), "decided_by",
        F.to_json(F.struct(F.lit("review").alias("source"), "rq_id")).alias("leader_meta"),
    )
    new = promote_aliases(taken.where("sponsor <> ''").select("company_id", "sponsor"), aliases)
    return decisions, new, queue.join(one.select("rq_id"), "rq_id", "left_anti")


def apply_to_trials(trials: DataFrame, decisions: DataFrame) -> DataFrame:
    """Trials with the company that was accepted for them (the smallest id if there were several)."""
    to = decisions.where("company_id is not null and company_id <> 0").groupBy("nct_id").agg(F.min("company_id").alias("_to"))
    return trials.join(to, "nct_id", "left").withColumn("sponsor_company_id", F.coalesce("_to", "sponsor_company_id")).drop("_to")


def reject(queue: DataFrame, rejected: DataFrame, label: bool = False) -> tuple[DataFrame, DataFrame]:
    """Negative labels for the best candidate of rejected(rq_id) items, if asked, and what stays in the queue.

    Candidates are structs (company_id, p); a missing p counts as 0, of equals the earlier is the best.
    """
    ids = rejected.select("rq_id").distinct()
    p = lambda c: F.coalesce(c["p"], F.lit(0.0))
    top = F.try_element_at(F.filter("candidates", lambda c: p(c) == F.array_max(F.transform("candidates", p))), F.lit(1))["company_id"]
    labels = queue.join(ids, "rq_id", "left_semi").select("nct_id", T.norm_name(F.col("sponsor")).alias("sponsor_text_norm"), top.alias("company_id"), F.lit(False).alias("is_match"), F.lit("human").alias("source"))
    return labels.where(F.col("company_id").isNotNull() & F.lit(label)), queue.join(ids, "rq_id", "left_anti")
