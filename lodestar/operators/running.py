"""Running sums, exact quantiles and precision curves over keys of any size.

Rows are sorted by range, so a large key lies in many ranges; what a range needs from those before it is one sum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.durable import kept


def running_sums(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with sums over the rows of the same keys up to and with each row; null values count as 0.

    Rows that tie in the order have a place of their own, which is kept.  No task holds a key: totals of (range, key)
    are chained, and only the first key of a range can have begun before it, so the carried sums that are sent
    to all tasks are one row for each range at most.
    """
    where = [*map(F.col, keys), *order]
    rows = kept(df.repartitionByRange(*where).sortWithinPartitions(*where).withColumn("_id", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_id", 33))
    zero = lambda c: F.coalesce(c, F.lit(0))
    totals = rows.groupBy("_range", *keys).agg(*(F.sum(c).alias(f"_{k}") for k, c in sums.items()))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_range").alias("_r"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.count("*").over(before).alias("_earlier"), *(F.sum(f"_{k}").over(before).alias(f"_{k}") for k in sums)).where("_earlier > 0")
    inside = Window.partitionBy("_range", *keys).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *(F.sum(c).over(inside).alias(k) for k, c in sums.items()))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)), F.col("_range") == F.col("_r"))
    out = local.join(F.broadcast(carried), same, "left").withColumns({k: zero(F.col(k)) + zero(F.col(f"_{k}")) for k in sums})
    return out.select(*df.columns, *sums)


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, shares: dict[str, float]) -> DataFrame:
    """keys and a column for each share: exact quantiles, interpolated between neighbours.

    Equal values are counted first; the two values beside a quantile are then those whose running counts span its
    rank.  Null values are left out, and so are keys that have no others.
    """
    counted = df.select(*keys, value.cast("double").alias("_v")).where("_v IS NOT NULL").groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    ranked = running_sums(counted, keys, [F.col("_v")], {"_to": F.col("_n")})
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    joined = ranked.join(sizes, keys) if keys else ranked.join(F.broadcast(sizes))  # one row
    at = lambda p: (F.col("_all") - 1) * F.lit(float(p))
    on = lambda rank: F.max(F.when((F.col("_to") - F.col("_n") <= rank) & (rank < F.col("_to")), F.col("_v")))
    picked = joined.groupBy(*keys).agg(F.max("_all").alias("_all"), *(on(f(at(p))).alias(f"_{side}{k}") for k, p in shares.items() for side, f in (("lo", F.floor), ("hi", F.ceil))))

    def between(k: str, p: float) -> Column:
        low, high = F.floor(at(p)), F.ceil(at(p))
        return F.when(low == high, F.col(f"_lo{k}")).otherwise((high - at(p)) * F.col(f"_lo{k}") + (at(p) - low) * F.col(f"_hi{k}"))

    return picked.select(*keys, *(between(k, p).alias(k) for k, p in shares.items()))


def precision_curve(rows: DataFrame, score: Column, positive: Column) -> DataFrame:
    """threshold, accepted, hits, precision: for each distinct score, of the rows with that score or a higher one."""
    by = rows.where(score.isNotNull()).groupBy(score.alias("threshold")).agg(F.count("*").alias("_n"), F.count_if(positive).alias("_p"))
    run = running_sums(by, [], [F.desc("threshold")], {"accepted": F.col("_n"), "hits": F.col("_p")})
    return run.select("threshold", "accepted", "hits", (F.col("hits") / F.col("accepted")).alias("precision"))


def threshold_for(curve: DataFrame, precision: float = 0.95, floor: float = 0.5) -> DataFrame:
    """tau_accept: the lowest threshold whose precision reaches that, or 1 where none does; at least `floor`."""
    lowest = F.min(F.when(F.col("precision") >= precision, F.col("threshold")))
    return curve.agg(F.greatest(F.lit(floor), F.coalesce(lowest, F.lit(1.0))).alias("tau_accept"))
