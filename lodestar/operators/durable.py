"""Results that later steps must see exactly once computed."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder that the cluster shares (spark.checkpoint.dir); where that is unset, a
    single machine gets a temporary folder and a cluster an error."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodestar-"))
    return df.checkpoint(eager=True)
