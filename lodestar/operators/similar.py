"""Texts that have most of their trigrams in common: all pairs from a similarity on, or only as far down as is asked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators.durable import kept

#: Similarities that `nearest` tries before the least one.
STEPS = (0.8, 0.6, 0.45)


def ranked(sought: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(q, a) and (text, b): each text's trigrams as numbers in one order, those rarest in `texts` first."""
    grams = lambda df, name: df.select(name).where(f"{name} IS NOT NULL").distinct().select(name, F.explode(T.trigrams(F.col(name))).alias("t"))
    a, b = grams(sought, "q"), grams(texts, "text")
    seen = b.groupBy("t").agg(F.count("*").alias("n")).unionByName(a.select("t", F.lit(0).cast("long").alias("n"))).groupBy("t").agg(F.sum("n").alias("n"))
    # trigrams are of 37 characters (a-z, 0-9, blank), so there are 50,653 at most
    place = kept(seen.select("t", F.row_number().over(Window.orderBy("n", "t")).alias("i")))
    lists = lambda df, name, out: kept(df.join(F.broadcast(place), "t").groupBy(name).agg(F.sort_array(F.collect_list("i")).alias(out)))
    return lists(a, "q", "a"), lists(b, "text", "b")


def met(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """Pairs that are compared: q, a, text, b; one can come several times.

    Of a set of n at least ceil(least * n) trigrams are shared, so two such sets meet on one of the first few of each. What a
    pair can still share after the first trigram that both have must be enough.
    """
    head = lambda g: F.posexplode(F.slice(g, 1, (F.size(g) - F.ceil(F.size(g) * least - 1e-9) + 1).cast("int")))
    rows = a.select("q", "a", head("a").alias("i", "t")).join(b.select("text", "b", head("b").alias("j", "t")), "t")
    na, nb = F.size("a"), F.size("b")
    size = F.least(na, nb) >= least * F.greatest(na, nb) - 1e-9
    left = F.least(na - F.col("i"), nb - F.col("j")) >= (na + nb) * (least / (1 + least)) - 1e-9
    return rows.where(size & left).select("q", "a", "text", "b")


def _within(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """q, text, sim of all pairs that have `least` in common, compared where they meet: only what is found is shuffled."""
    both = F.size(F.array_intersect("a", "b"))
    found = met(a, b, least).select("q", "text", (both / (F.size("a") + F.size("b") - both)).alias("sim"))
    return found.where(F.col("sim") >= least).distinct()


def similar_texts(sought: DataFrame, texts: DataFrame, least: float = 0.3) -> DataFrame:
    """q, text, sim: all pairs of sought(q) and texts(text) that have `least` of their trigrams in common (of those in
    either).

    Frequent trigrams, which most names have, are hardly ever joined on, and only pairs that pass filters by size and
    place are compared in whole.
    """
    return _within(*ranked(sought, texts), least)


def nearest(sought: DataFrame, texts: DataFrame, enough: Callable[[DataFrame], DataFrame], least: float = 0.3) -> DataFrame:
    """q, text, sim: of each sought(q) all pairs from some similarity on, which is `least` unless more similar ones are enough.

    `enough` gives the q for which the pairs (q, text, sim) that it gets will do; it gets all pairs of a q from a similarity
    on. Names that share most of their words are similar to every other name; so the highest similarities are tried first,
    and only a q that has not enough by then goes on to the next.
    """
    rest, b = ranked(sought, texts)
    out = None
    for step in (*(s for s in STEPS if s > least), least):
        pairs = kept(_within(rest, b, step))
        if step > least:
            done = kept(enough(pairs).select("q").distinct())
            pairs, rest = pairs.join(done, "q", "left_semi"), kept(rest.join(done, "q", "left_anti"))
        out = pairs if out is None else out.unionByName(pairs)
        if rest.isEmpty():
            break
    return out


def first_of_each(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")
