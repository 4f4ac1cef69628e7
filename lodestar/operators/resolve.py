"""Sponsor text to company: deterministic cascade, candidates, features, decisions, queues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions.stats import logistic
from lodestar.functions.udfs import jaro_winkler
from lodestar.operators.durable import kept
from lodestar.operators.similar import first_of_each, nearest

# Weights of the logistic score, its intercept, and the decision's limits.
WEIGHTS = {"jw_primary": 2.8, "token_set_ratio": 2.4, "acronym_exact": 1.9, "domain_root_match": 3.6, "academic_keyword_penalty": -1.2, "ticker_string_hit": 3.0}
INTERCEPT, TAU_ACCEPT, REVIEW_LOW, MIN_MARGIN = -5.0, 0.90, 0.60, 0.05
# Order of exchanges when a company has several listings.
EXCHANGES = (("NASDAQ", "XNAS"), ("NYSE", "XNYS"), ("NYSE AMERICAN", "AMEX", "XASE"), ("NYSE ARCA", "ARCX"), ("OTCQX",), ("OTCQB",))
#: Patterns that texts are tried against, at most.
PATTERNS = 10_000


def patterns(df: DataFrame) -> DataFrame:
    """A table of patterns, for broadcast: a text meets a pattern by trying it, for which there is no key to join on.  More
    than PATTERNS of them are an error, not a plan that doesn't end."""
    if df.limit(PATTERNS + 1).count() > PATTERNS:
        raise ValueError(f"more than {PATTERNS} patterns")
    return F.broadcast(df)


def unique_hit(sponsors: DataFrame, names: DataFrame, step: str) -> DataFrame:
    """sponsor, company_id where exactly one company has the sponsor's key; several companies: no hit."""
    met = sponsors.join(names, "key").groupBy("sponsor").agg(F.min("company_id").alias("lo"), F.max("company_id").alias("hi"))
    return met.where("lo = hi").select("sponsor", F.col("lo").alias("company_id"), F.lit(step).alias("step"))


def deterministic(sponsors: DataFrame, companies: DataFrame, aliases: DataFrame) -> DataFrame:
    """First step that finds exactly one company: alias strict, alias loose, name strict, name loose,
    alias domain, website.

    sponsors(sponsor); companies(company_id, name, website_domain); aliases(company_id, alias,
    alias_type).  All steps are one union, one join and two aggregations rather than a round a step.
    Returns sponsor, company_id, step for those that were found.
    """
    s = sponsors.select("sponsor").where("sponsor is not null").distinct()
    doms = F.explode_outer(T.domains(F.col("sponsor")))
    probes = [s.select("sponsor", F.lit(k).alias("rank"), key(F.col("sponsor")).alias("key")) for k, key in ((1, T.norm_name), (2, T.norm_loose), (3, T.norm_name), (4, T.norm_loose))]
    hosts = s.select("sponsor", doms.alias("key"))
    probes += [hosts.withColumn("rank", F.lit(k)).select("sponsor", "rank", "key") for k in (5, 6)]
    plain, host = aliases.where("alias_type <> 'domain'"), aliases.where("alias_type = 'domain'")
    keys = [
        plain.select("company_id", F.lit(1).alias("rank"), T.norm_name(F.col("alias")).alias("key")),
        plain.select("company_id", F.lit(2).alias("rank"), T.norm_loose(F.col("alias")).alias("key")),
        companies.select("company_id", F.lit(3).alias("rank"), T.norm_name(F.col("name")).alias("key")),
        companies.select("company_id", F.lit(4).alias("rank"), T.norm_loose(F.col("name")).alias("key")),
        host.select("company_id", F.lit(5).alias("rank"), F.lower("alias").alias("key")),
        companies.select("company_id", F.lit(6).alias("rank"), F.lower("website_domain").alias("key")),
    ]
    all_keys = reduce(DataFrame.unionByName, keys).where("key is not null and key <> ''").distinct()
    met = reduce(DataFrame.unionByName, probes).join(all_keys, ["rank", "key"])
    one = met.groupBy("sponsor", "rank").agg(F.min("company_id").alias("lo"), F.max("company_id").alias("hi")).where("lo = hi")
    names = F.element_at(F.array(*(F.lit(x) for x in ("alias_strict", "alias_loose", "name_strict", "name_loose", "alias_domain", "website"))), F.col("rank"))
    return one.groupBy("sponsor").agg(F.min_by(F.struct(F.col("lo").alias("company_id"), names.alias("step")), "rank").alias("r")).select("sponsor", "r.company_id", "r.step")


def by_rules(sponsors: DataFrame, rules: DataFrame, descending: bool = False) -> DataFrame:
    """First regular expression that matches the raw or normalised text, by priority then rule id.

    rules(rule_id, pattern, company_id, priority); the rules are at most PATTERNS and are broadcast.
    """
    s = sponsors.select("sponsor").where("sponsor is not null").distinct().withColumn("norm", T.norm_name(F.col("sponsor")))
    hit = F.expr("sponsor rlike concat('(?i)', pattern) or norm rlike concat('(?i)', pattern)")
    met = s.join(patterns(rules), hit)
    rank = F.struct((-F.col("priority") if descending else F.col("priority")).alias("p"), "rule_id")
    return met.groupBy("sponsor").agg(F.min_by(F.struct("company_id", "rule_id"), rank).alias("r")).select("sponsor", "r.company_id", "r.rule_id")


def not_ignored(sponsors: DataFrame, ignore: DataFrame) -> DataFrame:
    """Sponsors that no ignore pattern matches."""
    return sponsors.join(patterns(ignore.select("pattern")), F.expr("sponsor rlike concat('(?i)', pattern)"), "left_anti")


def candidates(sponsors: DataFrame, names: DataFrame, k: int = 10, least: float = 0.3) -> DataFrame:
    """The k companies whose name is most similar in trigrams: sponsor, company_id, name, sim.

    sponsors(sponsor), names(company_id, name).  Works on distinct normalised texts and looks only as far down as k
    companies ask.  Ties by company id.
    """
    q = sponsors.select("sponsor").where("sponsor is not null").distinct().withColumn("q", T.norm_name(F.col("sponsor")))
    known = names.select("company_id", "name").where("name is not null").withColumn("text", T.norm_name(F.col("name")))
    # of companies of one text only the first k can be among the k of any sponsor
    held = kept(first_of_each(known.groupBy("text", "company_id").agg(F.max("name").alias("name")), ["text"], ["company_id"], k))
    enough = lambda pairs: pairs.join(held, "text").groupBy("q").agg(F.countDistinct("company_id").alias("n")).where(F.col("n") >= k)
    near = nearest(q, held, enough, least).join(held, "text")
    top = near.groupBy("q", "company_id").agg(F.max("sim").alias("sim"), F.max_by("name", F.struct("sim", "name")).alias("name"))
    rank = Window.partitionBy("q").orderBy(F.desc("sim"), "company_id")
    best = top.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return q.join(best, "q").select("sponsor", "company_id", "sim", "name", "rank")


def best_security(securities: DataFrame) -> DataFrame:
    """One listing per company: by exchange, then ticker."""
    place = F.coalesce(*(F.when(F.upper("exchange").isin(*x), F.lit(i)) for i, x in enumerate(EXCHANGES, 1)), F.lit(99))
    w = Window.partitionBy("company_id").orderBy(place, "ticker")
    return securities.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def features(pairs: DataFrame) -> DataFrame:
    """Features of (sponsor, name, website_domain, ticker) pairs; only the string similarity is Python."""
    s, n = F.col("sponsor"), F.col("name")
    hosts = T.domains(s)
    ticker = F.upper(F.coalesce("ticker", F.lit("")))
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)
    ours = T.acronym(T.strip_legal(s))
    return pairs.select(
        "*",
        jaro_winkler(T.norm_name(s), T.norm_name(n)).alias("jw_primary"),
        T.dice(T.tokens(s), T.tokens(n)).alias("token_set_ratio"),
        flag((ours != "") & (ours == T.acronym(n))).alias("acronym_exact"),
        flag(F.array_contains(hosts, F.lower("website_domain"))).alias("domain_root_match"),
        flag((ticker != "") & F.array_contains(F.transform(T.tokens(s), F.upper), ticker)).alias("ticker_string_hit"),
        flag(T.is_academic(s)).alias("academic_keyword_penalty"),
        T.dice(T.strong_tokens(s), T.strong_tokens(n)).alias("strong_token_overlap"),
    )


def logistic_score(weights: dict[str, float] | None = None, intercept: float = INTERCEPT) -> Column:
    z = F.lit(intercept)
    for k, w in (weights or WEIGHTS).items():
        z = z + w * F.coalesce(F.col(k), F.lit(0.0))
    return logistic(z)


def decide(scored: DataFrame, tau: float = TAU_ACCEPT, low: float = REVIEW_LOW, margin: float = MIN_MARGIN) -> DataFrame:
    """Accept, review or reject per sponsor, from rows (sponsor, company_id, p)."""
    w = Window.partitionBy("sponsor").orderBy(F.desc("p"), "company_id")
    lead = scored.select("sponsor", "company_id", "p", F.row_number().over(w).alias("rn"), (F.col("p") - F.lead("p", 1, 0.0).over(w)).alias("margin")).where("rn = 1")
    mode = F.when((F.col("p") >= tau) & (F.col("margin") >= margin), "accept").when(F.col("p") >= low, "review").otherwise("reject")
    return lead.select("sponsor", mode.alias("mode"), F.when(mode != "reject", F.col("company_id")).alias("company_id"), "p", "margin")


def review_queue(scored: DataFrame, decisions: DataFrame, pending: DataFrame | None = None, k: int = 5) -> DataFrame:
    """Rows for people to decide: the sponsor and its candidates, best first; not what is pending already."""
    todo = decisions.where("mode = 'review'").select("sponsor")
    if pending is not None:
        todo = todo.join(pending.select("sponsor"), "sponsor", "left_anti")
    w = Window.partitionBy("sponsor").orderBy(F.desc("p"), "company_id")
    top = scored.join(todo, "sponsor").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    packed = F.sort_array(F.collect_list(F.struct("rn", "company_id", "p")))
    return top.groupBy("sponsor").agg(packed.alias("c")).select("sponsor", F.transform("c", lambda x: F.struct(x["company_id"].alias("company_id"), x["p"].alias("p"))).alias("candidates"))


def training_rows(scored: DataFrame, accepted: DataFrame, negatives: int = 20) -> DataFrame:
    """Accepted pairs as positives, and of each sponsor the highest other candidates as hard negatives."""
    good = scored.join(accepted.select("sponsor", "company_id"), ["sponsor", "company_id"]).withColumn("label", F.lit(1))
    w = Window.partitionBy("sponsor").orderBy(F.desc("p"), "company_id")
    known = accepted.select("sponsor").distinct()
    bad = scored.join(known, "sponsor", "left_semi").join(accepted.select("sponsor", "company_id"), ["sponsor", "company_id"], "left_anti").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= negatives).drop("rn").withColumn("label", F.lit(0))
    return good.unionByName(bad)


def promote_aliases(accepted: DataFrame, aliases: DataFrame) -> DataFrame:
    """New alias rows from accepted sponsor texts: legal if they end in a company form, else aka."""
    kind = F.when(T.strip_legal(F.col("sponsor")) != T.norm_name(F.col("sponsor")), "legal").otherwise("aka")
    new = accepted.select("company_id", F.col("sponsor").alias("alias"), T.norm_name(F.col("sponsor")).alias("alias_norm"), kind.alias("alias_type")).distinct()
    return new.join(aliases.select("company_id", T.norm_name(F.col("alias")).alias("alias_norm")).distinct(), ["company_id", "alias_norm"], "left_anti")


def roll_up(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Top parent of every child in edges(parent, child): child, top, depth, at any depth.

    Paths are joined end to end, so their length doubles each round and a chain of n takes log2(n) rounds.  A
    node with several parents gives a row per top and length; one that only leads into a cycle gives none.
    """
    links = edges.select("child", "parent").where("child is not null and parent is not null").distinct()
    tops = links.select("parent").distinct().join(links.select(F.col("child").alias("parent")), "parent", "left_anti")
    paths = kept(links.join(tops.withColumn("_top", F.lit(True)), "parent", "left").select("child", F.col("parent").alias("node"), F.lit(1).cast("long").alias("depth"), F.coalesce("_top", F.lit(False)).alias("done")))
    longest = paths.count()
    for r in range(rounds):
        open_ = paths.where("not done")
        if (1 << r) > longest or open_.isEmpty():
            break
        on = paths.select(F.col("child").alias("node"), F.col("node").alias("_to"), F.col("depth").alias("_more"), F.col("done").alias("_end"))
        further = open_.join(on, "node").select("child", F.col("_to").alias("node"), (F.col("depth") + F.col("_more")).alias("depth"), F.col("_end").alias("done"))
        paths = kept(paths.where("done").unionByName(further.where("child <> node or done")).distinct())
    return paths.where("done").select("child", F.col("node").alias("top"), F.col("depth").cast("int").alias("depth"))
