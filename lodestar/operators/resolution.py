"""One job from unresolved trials to decisions: rules, similar names, nine features, a score, and what is kept of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions.udfs import jaro_winkler
from lodestar.operators import resolve, review, similar
from lodestar.operators.durable import kept
from lodestar.operators.similar import first_of_each, nearest, similar_texts

FEATURES = ("jw_primary", "token_set_ratio", "acronym_exact", "domain_root_match", "ticker_string_hit", "academic_keyword_penalty", "strong_token_overlap", "drug_code_hit", "extra_domain_hit")


def _met(sought: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs that the filters leave: q, text."""
    return similar.met(*similar.ranked(sought, texts), least).select("q", "text").distinct()


def retrieve(sponsors: DataFrame, companies: DataFrame, aliases: DataFrame, securities: DataFrame, k: int = 50) -> DataFrame:
    """sponsor, company_id, sim, rank, name, website_domain, domains, ticker, exchange: the k most similar companies.

    Half of k come from names and half from aliases (at least one each), by trigrams of normalised texts; a company's best
    counts, ties go by company id.  domains are its aliases of that type, without www., securities(company_id,
    ticker, exchange) give its first listing.
    """
    half = max(1, k // 2)
    q = sponsors.select("sponsor").where("sponsor is not null").distinct().withColumn("q", T.norm_name(F.col("sponsor")))
    # of rows of one text only the first half of k can be among those of any sponsor
    named = kept(first_of_each(companies.select("company_id", T.norm_name(F.col("name")).alias("text")), ["text"], ["company_id"], half))
    called = kept(first_of_each(aliases.select("company_id", T.norm_name(F.col("alias")).alias("text")), ["text"], ["company_id"], half))
    held = kept(named.groupBy("text").agg(F.count("*").alias("a"), F.lit(0).cast("long").alias("b")).unionByName(called.groupBy("text").agg(F.lit(0).cast("long").alias("a"), F.count("*").alias("b"))).groupBy("text").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    enough = lambda pairs: pairs.join(held, "text").groupBy("q").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where((F.col("a") >= half) & (F.col("b") >= half))
    sims = kept(nearest(q, held, enough))

    def best(texts: DataFrame, ties: list[str]) -> DataFrame:
        return first_of_each(sims.join(texts, "text"), ["q"], [F.desc("sim"), *ties], half).select("q", "company_id", "sim")

    top = best(named, ["company_id"]).unionByName(best(called, ["company_id", "text"])).groupBy("q", "company_id").agg(F.max("sim").alias("sim"))
    ranked = top.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "company_id"))).where(F.col("rank") <= k)
    hosts = aliases.where("alias_type = 'domain' AND alias IS NOT NULL").groupBy("company_id").agg(F.array_sort(F.collect_set(F.lower(F.regexp_replace("alias", r"^www\.", "")))).alias("domains"))
    listed = resolve.best_security(securities).select("company_id", "ticker", "exchange")
    about = companies.select("company_id", "name", F.coalesce("website_domain", F.lit("")).alias("website_domain"))
    out = q.join(ranked, "q").join(about, "company_id").join(hosts, "company_id", "left").join(listed, "company_id", "left")
    return out.select("sponsor", "company_id", "sim", "rank", "name", "website_domain", F.coalesce("domains", F.array().cast("array<string>")).alias("domains"), "ticker", "exchange")


def nine_features(pairs: DataFrame) -> DataFrame:
    """pairs(sponsor, name, website_domain, domains, ticker, context_domains, drug_code_hit) with FEATURES.

    Hosts of a company are its website and its domains; those of a sponsor are in its text or its context.
    """
    return _context_features(_text_features(pairs))


def _flag(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)


def _text_features(pairs: DataFrame) -> DataFrame:
    """The features that the sponsor's text and the company decide, whatever the trial."""
    s, n = F.col("sponsor"), F.col("name")
    ours = T.acronym(T.strip_legal(s))
    ticker = F.upper(F.coalesce("ticker", F.lit("")))
    return pairs.select(
        "*",
        jaro_winkler(T.norm_name(s), T.norm_name(n)).alias("jw_primary"),
        T.dice(T.tokens(s), T.tokens(n)).alias("token_set_ratio"),
        _flag((ours != "") & (ours == T.acronym(n))).alias("acronym_exact"),
        _flag((ticker != "") & F.array_contains(F.transform(T.tokens(s), F.upper), ticker)).alias("ticker_string_hit"),
        _flag(T.is_academic(s)).alias("academic_keyword_penalty"),
        T.dice(T.strong_tokens(s), T.strong_tokens(n)).alias("strong_token_overlap"),
        T.domains(s).alias("_named"),
    )


def _context_features(rows: DataFrame) -> DataFrame:
    """The features that a trial's context has a part in."""
    none = F.array().cast("array<string>")
    context = F.coalesce("context_domains", none)
    site = F.when(F.col("website_domain") != "", F.array(F.lower("website_domain"))).otherwise(none)
    hosts = F.concat(site, F.transform(F.filter(F.coalesce("domains", none), lambda d: d != ""), F.lower))
    return rows.withColumns(
        {
            "domain_root_match": _flag(F.arrays_overlap(F.concat("_named", F.transform(context, F.lower)), hosts)),
            "extra_domain_hit": _flag(F.arrays_overlap(context, hosts)),
            "drug_code_hit": _flag(F.col("drug_code_hit")),
        }
    ).drop("_named")


def resolve_trials(
    trials: DataFrame, companies: DataFrame, aliases: DataFrame, securities: DataFrame, rules: DataFrame, ignore: DataFrame, run_id: Column, *,
    weights: dict[str, float] | None = None, intercept: float = resolve.INTERCEPT, tau: float = resolve.TAU_ACCEPT, low: float = resolve.REVIEW_LOW, margin: float = resolve.MIN_MARGIN, k: int = 50,
) -> dict[str, DataFrame]:
    """All unresolved trials(nct_id, sponsor_text, sponsor_company_id, context_domains, drug_code_hit) in one plan.

    Trials without a sponsor, with a company already, or whose sponsor an ignore pattern matches are left out.  A
    sponsor that names one company exactly, or else by a rule, is decided at once; the others get candidates,
    features and a score.  Returns decisions (a row per trial that was decided or tried), features (a row per trial and
    candidate), queue (trials for people, with their five best candidates), aliases (new ones from what was
    accepted) and trials (with the companies accepted).  Each sponsor text is worked out once, however many trials
    share it.
    """
    open_ = trials.where("sponsor_text IS NOT NULL AND coalesce(sponsor_company_id, 0) = 0").withColumnRenamed("sponsor_text", "sponsor")
    todo = kept(resolve.not_ignored(open_, ignore))
    sponsors = todo.select("sponsor").distinct()
    exact = resolve.deterministic(sponsors, companies, aliases)
    by_rule = resolve.by_rules(sponsors.join(exact, "sponsor", "left_anti"), rules).select("sponsor", "company_id", F.lit("rule").alias("step"))
    sure = kept(exact.unionByName(by_rule))
    rest = todo.join(sure, "sponsor", "left_anti")
    found = kept(_text_features(retrieve(rest, companies, aliases, securities, k)))
    pairs = rest.select("nct_id", "sponsor", "context_domains", "drug_code_hit").join(found, "sponsor")
    scored = kept(_context_features(pairs).withColumn("p", resolve.logistic_score(weights, intercept)))
    # a trial is decided on its own, as its context counts
    decided = resolve.decide(scored.select(F.col("nct_id").alias("sponsor"), "company_id", "p"), tau, low, margin).withColumnRenamed("sponsor", "nct_id")
    texts = todo.select("nct_id", "sponsor")
    at_once = texts.join(sure, "sponsor").select("nct_id", "sponsor", "company_id", F.lit("accept").alias("mode"), F.concat(F.lit("det:"), "step").alias("method"), F.lit(1.0).alias("p"), F.lit(1.0).alias("margin"))
    tried = texts.join(decided, "nct_id").select("nct_id", "sponsor", "company_id", "mode", F.lit("prob").alias("method"), "p", "margin")
    decisions = kept(at_once.unionByName(tried)).withColumn("run_id", run_id)
    w = Window.partitionBy("nct_id").orderBy(F.desc("p"), "company_id")
    best = scored.join(decisions.where("mode = 'review'").select("nct_id"), "nct_id").withColumn("_n", F.row_number().over(w)).where("_n <= 5")
    packed = F.transform(F.array_sort(F.collect_list(F.struct("_n", "company_id", "p"))), lambda c: F.struct(c["company_id"].alias("company_id"), c["p"].alias("p")))
    queue = best.groupBy("nct_id", "sponsor").agg(packed.alias("candidates")).withColumn("run_id", run_id)
    accepted = decisions.where("mode = 'accept'")
    return {
        "decisions": decisions,
        "features": review.candidate_rows(scored, run_id, list(FEATURES)),
        "queue": queue,
        "aliases": resolve.promote_aliases(accepted.where("sponsor <> ''").select("company_id", "sponsor"), aliases),
        "trials": review.apply_to_trials(trials, accepted.select("nct_id", "company_id")),
    }
