"""Likelihood ratios and priors from past trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least numbers, weights of the defaults, bounds.
LEAST_TRIALS, LR_SHRINK, LR_BOUNDS = 10, 0.1, (1.0, 100.0)
LEAST_CATEGORY, PRIOR_SHRINK = 5, 0.2
DEFAULT_LR = {("G1", "H"): 10.0, ("G1", "M"): 5.0, ("G2", "H"): 15.0, ("G2", "M"): 8.0, ("G3", "H"): 12.0, ("G3", "M"): 6.0, ("G4", "H"): 20.0, ("G4", "M"): 10.0}


def gate_ratios(history: DataFrame, own_baseline: bool = True) -> DataFrame:
    """Ratio per gate and severity, from rows (trial, gate, severity, failed), with at least ten trials.

    own_baseline compares the rate with itself, as the published scores do: the ratio is 1, or 0.1
    without failures.  Otherwise the baseline is the failure rate of all rows.
    """
    hit = history.groupBy("gate", "severity").agg(F.count("*").alias("n"), F.avg(F.col("failed").cast("double")).alias("rate")).where(F.col("n") >= LEAST_TRIALS)
    if own_baseline:
        baseline = F.col("rate")
    else:
        hit = hit.crossJoin(F.broadcast(history.agg(F.avg(F.col("failed").cast("double")).alias("overall"))))  # one row
        baseline = F.col("overall")
    raw = F.greatest(F.col("rate") / F.when(baseline == 0, 0.01).otherwise(baseline), F.lit(0.1))
    default = F.coalesce(*(F.when((F.col("gate") == g) & (F.col("severity") == s), F.lit(v)) for (g, s), v in DEFAULT_LR.items()), F.lit(5.0))
    smooth = F.bround((1 - LR_SHRINK) * F.bround(raw, 2) + LR_SHRINK * default, 2)
    return hit.select("gate", "severity", "n", F.greatest(F.lit(LR_BOUNDS[0]), F.least(F.lit(LR_BOUNDS[1]), smooth)).alias("lr"))


def category_priors(history: DataFrame, failed: Column, categories: dict[str, Column]) -> DataFrame:
    """Failure rate per category, shrunk to the overall rate, in one pass: category, n, prior.

    Fewer than five trials take the overall rate.
    """
    aggs = [F.avg(failed.cast("double")).alias("overall")]
    for k, c in categories.items():
        aggs += [F.count_if(c).alias(f"n_{k}"), F.avg(F.when(c, failed.cast("double"))).alias(f"r_{k}")]
    one = history.agg(*aggs)
    rate = lambda k: F.when(F.col(f"n_{k}") < LEAST_CATEGORY, F.col("overall")).otherwise(F.round(f"r_{k}", 5))
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("category"), F.col(f"n_{k}").alias("n"), F.round((1 - PRIOR_SHRINK) * rate(k) + PRIOR_SHRINK * F.col("overall"), 5).alias("prior")) for k in categories)))
    return one.select(rows.alias("r")).select("r.*")


def fold_metrics(rows: DataFrame, key: str, predicted: Column, actual: Column, folds: int = 5) -> DataFrame:
    """Accuracy per fold of a hash of the key, and its mean and deviation over folds."""
    fold = rows.groupBy(F.pmod(F.col(key), F.lit(folds)).alias("fold")).agg(F.avg((predicted == actual).cast("double")).alias("accuracy"), F.count("*").alias("n"))
    over = Window.partitionBy()
    return fold.select("fold", "n", "accuracy", F.avg("accuracy").over(over).alias("mean_accuracy"), F.stddev_pop("accuracy").over(over).alias("std_accuracy"))


def confusion(rows: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Counts and the usual rates; a rate without cases is 0."""
    c = rows.agg(F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"), F.count_if(~predicted & actual).alias("fn"), F.count_if(~predicted & ~actual).alias("tn"))
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("*", rate(tp + tn, tp + fp + fn + tn).alias("accuracy"), rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"), rate(2 * tp, 2 * tp + fp + fn).alias("f1"), rate(tn, tn + fp).alias("specificity"))


def auc(rows: DataFrame, score: Column, positive: Column) -> DataFrame:
    """Area under the ROC curve from rank sums over distinct scores.

    Scores are aggregated first; running totals come from sums by range of scores, so no task sorts
    all rows: only distinct scores of one range meet.
    """
    by = rows.groupBy(score.alias("s")).agg(F.count_if(positive).cast("double").alias("p"), F.count_if(~positive).cast("double").alias("n"))
    ranges = by.repartitionByRange("s").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    local = ranges.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0.0)))
    parts = local.groupBy("part").agg(F.sum("p").alias("pp"), F.sum("n").alias("nn"), F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("u"))
    before = F.coalesce(F.sum("nn").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    done = parts.withColumn("u", F.col("u") + F.col("pp") * before)
    return done.agg(F.try_divide(F.sum("u"), F.sum("pp") * F.sum("nn")).alias("auc"))
