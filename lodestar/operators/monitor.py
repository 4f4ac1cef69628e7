"""Run metrics, alerts and summaries over trailing windows; `now` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits beyond which an alert is due.
ERROR_RATE, SLOW_SECONDS, MEMORY, DISK, QUALITY, CRITICAL = 0.1, 3600, 80.0, 90.0, 0.6, 0


def run_metrics(runs: DataFrame) -> DataFrame:
    """Adds duration_seconds, processing_rate and error_rate (0 without records)."""
    seconds = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / F.lit(1e6)
    out = runs.withColumn("duration_seconds", seconds)
    rate = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return out.withColumn("processing_rate", rate(F.col("records_processed"), F.col("duration_seconds"))).withColumn("error_rate", rate(F.col("error_count"), F.col("records_processed")))


def _alerts(rows: DataFrame, keys: list[str], rules: list[tuple[str, str, Column]]) -> DataFrame:
    hits = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(a).alias("alert_type"), F.lit(s).alias("severity"))) for a, s, c in rules)))
    return rows.select(*keys, F.explode(hits).alias("x")).select(*keys, "x.*")


def run_alerts(metrics: DataFrame) -> DataFrame:
    return _alerts(metrics, ["execution_id"], [("pipeline_failure", "critical", ~F.col("success")), ("error_rate_high", "high", F.col("error_rate") > ERROR_RATE), ("performance_issue", "medium", F.col("duration_seconds") > SLOW_SECONDS)])


def system_alerts(samples: DataFrame) -> DataFrame:
    return _alerts(samples, ["ts"], [("memory", "high", F.col("memory_percent") > MEMORY), ("disk", "critical", F.col("disk_percent") > DISK)])


def quality_alerts(metrics: DataFrame) -> DataFrame:
    return _alerts(metrics, ["ts"], [("quality_degradation", "medium", F.col("score") < QUALITY), ("critical_issues", "critical", F.col("critical") > CRITICAL)])


def open_alerts(events: DataFrame) -> DataFrame:
    """Latest state per alert from events(alert_id, ts, action); resolved ones are left out."""
    return events.groupBy("alert_id").agg(F.max_by("action", F.struct("ts", "action")).alias("state"), F.max("ts").alias("since")).where("state <> 'resolved'")


def performance(metrics: DataFrame, by: str, now: Column, hours: int) -> DataFrame:
    """Per `by` over the last hours: runs, success rate, mean duration, error rate, and the sum of positive
    rates over all runs."""
    recent = metrics.where(F.col("start_time").cast("timestamp") >= now.cast("timestamp") - F.make_interval(hours=F.lit(hours)))
    return recent.groupBy(by).agg(F.count("*").alias("runs"), F.avg(F.col("success").cast("double")).alias("success_rate"), F.avg("duration_seconds").alias("mean_duration"), (F.sum(F.when(F.col("processing_rate") > 0, F.col("processing_rate")).otherwise(0.0)) / F.count("*")).alias("mean_rate"), F.avg("error_rate").alias("error_rate"))


def system_summary(samples: DataFrame, value: str, ts: str = "ts") -> DataFrame:
    return samples.agg(F.avg(value).alias("mean"), F.max(value).alias("peak"), F.max_by(value, F.struct(ts, value)).alias("current"))


def unmet_dependencies(runs: DataFrame, dependencies: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Pipelines whose dependency has no successful run in the last hours."""
    fresh = runs.where(F.col("success") & (F.col("end_time").cast("timestamp") >= now.cast("timestamp") - F.make_interval(hours=F.lit(hours)))).select(F.col("pipeline_name").alias("depends_on")).distinct()
    return dependencies.join(fresh, "depends_on", "left_anti")
