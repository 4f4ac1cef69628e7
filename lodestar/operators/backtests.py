"""Rankings as they stood on past days, how good they were, and which days of a pipeline are still to be run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = "interval 1 day"


def snapshots(rankings: DataFrame, start: Column, end: Column, every: int = 1) -> DataFrame:
    """Every trial's state on each snapshot day (start, start + every days, ... up to end): snapshot_date and the columns of
    rankings(trial_id, captured_at, ...), of the last row captured on or before that day.

    A row holds from its day until the next one of its trial, so it is repeated for the snapshot days within that
    stretch and days never meet all trials.  Of rows captured on one day the last counts (then the largest row as
    a whole); trials without a row by then aren't in the snapshot.
    """
    day = F.to_date("captured_at")
    rest = [c for c in rankings.columns if c != "trial_id"]
    last = rankings.where(F.col("trial_id").isNotNull() & F.col("captured_at").isNotNull()).groupBy("trial_id", day.alias("_day")).agg(F.max_by(F.struct(*rest), F.struct("captured_at", *(c for c in rest if c != "captured_at"))).alias("r"))
    until = F.coalesce(F.date_sub(F.lead("_day").over(Window.partitionBy("trial_id").orderBy("_day")), 1), end)
    held = last.withColumn("_until", F.least(until, end))
    # the first snapshot day that isn't before the row's day
    steps = F.greatest(F.lit(0), F.ceil(F.datediff(F.col("_day"), start) / every)).cast("int")
    first = F.date_add(start, steps * every)
    days = F.when(first <= F.col("_until"), F.sequence(first, F.col("_until"), F.expr(f"interval {every} days")))
    return held.select("trial_id", F.explode(days).alias("snapshot_date"), "r.*")


def precision_by_day(states: DataFrame, outcomes: DataFrame, score: Column, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """snapshot_date, k, precision, recall, f1 of the first k of each snapshot, highest score first, then trial id.

    outcomes(trial_id, success): a trial without outcome failed, as in `precision_at`; recall counts the failures
    of the snapshot.  A k beyond the snapshot's size is left out.  Only the largest k rows of a day are ranked
    beyond the task that reads them.
    """
    failed = ~F.coalesce("success", F.lit(False))
    rows = states.select("snapshot_date", "trial_id", score.alias("_s")).join(outcomes.select("trial_id", "success"), "trial_id", "left").withColumn("failed", failed)
    totals = rows.groupBy("snapshot_date").agg(F.count("*").alias("n"), F.count_if("failed").alias("all_failed"))
    rank = F.row_number().over(Window.partitionBy("snapshot_date").orderBy(F.desc_nulls_last("_s"), "trial_id"))
    head = rows.withColumn("rank", rank).where(F.col("rank") <= max(ks))
    hits = head.groupBy("snapshot_date").agg(*(F.count_if((F.col("rank") <= k) & F.col("failed")).alias(f"h{k}") for k in ks))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("hits")) for k in ks)))
    flat = hits.join(totals, "snapshot_date").select("snapshot_date", "n", "all_failed", each.alias("e")).select("snapshot_date", "n", "all_failed", "e.*").where("k <= n")
    precision, recall = F.col("hits") / F.col("k"), F.coalesce(F.try_divide(F.col("hits"), F.col("all_failed")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return flat.select("snapshot_date", "k", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def report(states: DataFrame, results: DataFrame) -> DataFrame:
    """One row: snapshots, trials, first and last day, and the means of precision and recall."""
    a = states.agg(F.count("*").alias("snapshots"), F.countDistinct("trial_id").alias("trials"), F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day"))
    b = results.agg(F.avg("precision").alias("mean_precision"), F.avg("recall").alias("mean_recall"))
    return a.join(F.broadcast(b))  # one row each


def missing_days(runs: DataFrame, start: Column, end: Column) -> DataFrame:
    """pipeline_name, first_day, last_day, days: the stretches of days from start to end on which a pipeline had no successful
    run, from runs(pipeline_name, day, success).  Each gap lies between two days with a run, so no calendar is made;
    pipelines appear that have any run, at whatever time."""
    known = runs.where(F.col("pipeline_name").isNotNull())
    done = known.where(F.col("success") & F.col("day").between(start, end)).select("pipeline_name", "day").distinct()
    edges = known.select("pipeline_name").distinct().select("pipeline_name", F.explode(F.array(F.date_sub(start, 1), F.date_add(end, 1))).alias("day"))
    following = F.lead("day").over(Window.partitionBy("pipeline_name").orderBy("day"))
    gaps = done.unionByName(edges).withColumn("_next", following).where(F.datediff("_next", "day") > 1)
    return gaps.select("pipeline_name", F.date_add("day", 1).alias("first_day"), F.date_sub("_next", 1).alias("last_day"), (F.datediff("_next", "day") - 1).alias("days"))


def ready(runs: DataFrame, needs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """pipeline_name, ready, waits_for of needs(pipeline_name, needed): a pipeline may run if each one it needs has had a
    successful run that began within so many hours; a null need asks for nothing."""
    last = runs.where("success").groupBy(F.col("pipeline_name").alias("needed")).agg(F.max(F.col("start_time").cast("timestamp")).alias("_last"))
    fresh = F.col("_last").isNotNull() & (F.unix_micros(now) - F.unix_micros("_last") <= F.lit(hours * 3_600_000_000))
    judged = needs.join(last, "needed", "left").withColumn("_waits", F.when(F.col("needed").isNotNull() & ~fresh, F.col("needed")))
    return judged.groupBy("pipeline_name").agg((F.count("_waits") == 0).alias("ready"), F.array_sort(F.collect_set("_waits")).alias("waits_for"))
