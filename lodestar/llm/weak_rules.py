"""Quality rules as weak supervision, in DataFrame expressions only.

Every rule votes for (+1), against (-1) or abstains (0) on a text.  Expectation-maximisation over the
table of vote patterns (at most 3 ** rules rows, whatever the number of texts) estimates how often
each rule is right; the posterior probability of `good` then replaces the usual demand that all rules
pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import WHITE, WORD_BREAK, settle

SYMBOLS = "#*$%&|<>"


def base_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and further counts of whole
    texts; a null text is empty.  One pass, no shuffle; cost n log n in the words of a text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = lambda x: F.btrim(x, F.lit(WHITE)) == ""
    one = df.select(
        F.col(id_col),
        text.alias("_t"),
        F.filter(F.split(text, WORD_BREAK), lambda w: w != "").alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: ~blank(x)).alias("_l"),
    )
    # a window's hash, with the place of its first word; windows that are met twice stand together once sorted
    hashes = F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))
    two = one.select(
        id_col,
        "_t",
        F.size("_w").alias("n_words"),
        F.size("_l").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        F.size(F.array_distinct("_w")).alias("n_distinct_words"),
        F.when(F.size("_w") >= 3, F.slice(hashes, F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0)))).otherwise(F.expr("array()").cast("array<bigint>")).alias("_g"),
    )
    pairs = F.array_sort(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), pairs))
    same = lambda x, k: F.coalesce(F.get("_s", k)["h"] == x["h"], F.lit(False))
    met = F.array_sort(F.transform(F.filter("_s", lambda x, k: same(x, k + 1) | (F.when(k > 0, same(x, k - 1)).otherwise(False))), lambda x: x["i"]))
    four = three.withColumn("_r", F.when(F.col("_s").isNotNull(), met))
    covered = F.aggregate("_r", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")), lambda a: a["n"])
    n = lambda c: c.cast("long")
    count_of = lambda chars: n(F.length("_t") - F.length(F.translate("_t", chars, "")))
    return four.select(
        id_col,
        n(F.col("n_words")).alias("n_words"),
        n(F.length(F.translate("_t", WHITE, ""))).alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"),
        n(F.col("n_dup_lines")).alias("n_dup_lines"),
        n(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        n(F.col("n_lines")).alias("n_lines"),
        n(F.col("n_distinct_words")).alias("n_distinct_words"),
        count_of("!?").alias("n_shouts"),
        count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        count_of("0123456789").alias("n_digits"),
    )


def rules() -> dict[str, Column]:
    """Votes over the columns of base_features: -1, +1 or 0 (abstains).  All are exact comparisons of
    whole numbers.  Most rules know only one kind of bad text and abstain otherwise, so that kinds
    that never meet in a text don't outvote each other."""
    c = F.col

    def against(bad: Column) -> Column:
        return F.when(bad, -1).otherwise(0)

    plain = (c("n_words") >= 50) & (100 * c("n_symbols") <= c("n_words")) & (100 * c("n_repeat_words") <= 10 * c("n_words")) & (100 * c("n_shouts") <= 5 * c("n_words")) & (100 * c("n_capitals") <= 8 * c("word_chars"))
    return {
        "length": against(c("n_words") < 50),
        "symbol_words": against(100 * c("n_symbols") > 10 * c("n_words")),
        "symbol_chars": against(100 * c("n_symbols") > 3 * c("word_chars")),
        "repeats": against(100 * c("n_repeat_words") > 30 * c("n_words")),
        "dup_lines": against(100 * c("n_dup_lines") > 50 * c("n_lines")),
        "variety": against((c("n_words") >= 20) & (100 * c("n_distinct_words") < F.when(c("n_words") > 2000, 10).otherwise(25) * c("n_words"))),
        "word_length": against((c("word_chars") < 3 * c("n_words")) | (c("word_chars") > 10 * c("n_words"))),
        "shouts": against(100 * c("n_shouts") > 30 * c("n_words")),
        "capitals": against(100 * c("n_capitals") > 40 * c("word_chars")),
        "plain": F.when(plain, 1).otherwise(0),
    }


def expect_maximise(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, *, prior: float = 0.7, accuracy: float = 0.8, weight: float = 10.0, rounds: int = 300) -> list[float]:
    """Fit each rule's accuracy (how often a vote of it is right) from counted vote patterns.

    The share of good texts is held at `prior`: were it free, rules that seldom vote would be
    explained away.  `weight` imagined votes, right `accuracy` of the time, start each rule off; no
    rule falls under 0.5, so that `good` stays the class of the +1.
    """
    right = [accuracy] * n_rules
    for _ in range(rounds):
        hits, votes = [weight * accuracy] * n_rules, [weight] * n_rules
        for pattern, n in patterns:
            good = posterior(pattern, prior, right)
            for j, v in enumerate(pattern):
                if v:
                    votes[j] += n
                    hits[j] += n * (good if v > 0 else 1 - good)
        fresh = [min(0.999, max(0.5, h / t)) for h, t in zip(hits, votes, strict=True)]
        done = max(abs(a - b) for a, b in zip(fresh, right, strict=True)) < 1e-10
        right = fresh
        if done:
            break
    return right


def posterior(pattern: tuple[int, ...], prior: float, right: list[float]) -> float:
    logit = math.log(prior / (1 - prior)) + sum(v * math.log(a / (1 - a)) for v, a in zip(pattern, right, strict=True))
    return 1 / (1 + math.exp(-logit))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, prior: float = 0.7, keep_from: float = 0.5) -> DataFrame:
    """Judge every whole text; returns the base features, base_failed, the votes (vote_*), quality
    (posterior of good) and kept (quality >= keep_from and not base_failed).

    Features are computed once and written to the checkpoint folder (a few numbers a text); the only
    thing that reaches the driver is the table of vote patterns.  Null and empty texts fail the base;
    repeated rows each give a row and count each; of an empty table nothing is returned.
    """
    voters = rules()
    names = [f"vote_{k}" for k in voters]
    features = base_features(df, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = settle(features.select("*", failed.alias("base_failed"), *(v.cast("int").alias(f"vote_{k}") for k, v in voters.items())))
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in voted.groupBy(*names).count().collect())
    right = expect_maximise(patterns, len(names), prior=prior)
    logit = F.lit(math.log(prior / (1 - prior)))
    for name, a in zip(names, right, strict=True):
        logit = logit + F.col(name) * F.lit(math.log(a / (1 - a)))
    quality = 1 / (1 + F.exp(-logit))
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from))
