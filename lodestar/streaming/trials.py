"""Structured Streaming twins of two batch operators (an extension; the batch forms are the reference)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from lodestar.functions.text import endpoint_concept

LATE_DAYS = 180


def endpoint_changes(versions: DataFrame, watermark: str = "7 days") -> DataFrame:
    """Late endpoint changes in a stream of versions (trial_id, version_id, captured_at, endpoint,
    completion); state is the last concept of each trial, one short text.

    Versions of a trial are compared in order of capture within a micro-batch, and with the last one of
    the batches before.  Versions older than the watermark are dropped.
    """
    concept = F.concat_ws("|", *(endpoint_concept(F.col("endpoint"))[k] for k in ("class", "timepoint", "ni", "blinded")))
    left = F.datediff(F.col("completion").cast("date"), F.col("captured_at").cast("date"))
    rows = versions.withWatermark("captured_at", watermark).select("trial_id", "version_id", "captured_at", concept.alias("concept"), left.alias("left"))

    def step(key, batches, state):
        last = state.get[0] if state.exists else None
        frame = pd.concat(list(batches)).sort_values(["captured_at", "version_id"])
        out = []
        for version, now, days in zip(frame["version_id"], frame["concept"], frame["left"], strict=True):
            if last is not None and now != last and pd.notna(days) and days <= LATE_DAYS:
                out.append((key[0], version, last, now))
            last = now
        state.update((last,))
        yield pd.DataFrame(out, columns=["trial_id", "version_id", "was", "now"])

    return rows.groupBy("trial_id").applyInPandasWithState(step, "trial_id long, version_id long, was string, now string", "concept string", "append", GroupStateTimeout.NoTimeout)


def run_rates(runs: DataFrame, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Runs and failures per pipeline and time window, late rows up to the watermark."""
    return runs.withWatermark("start_time", watermark).groupBy(F.window("start_time", window), "pipeline_name").agg(F.count("*").alias("runs"), F.count_if(~F.col("success")).alias("failures"))
