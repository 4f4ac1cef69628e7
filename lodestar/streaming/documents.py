"""Fetched pages as a stream: each batch becomes its part of six tables, as often as it is run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import doc_store


def stored(spark: SparkSession, folder: str, table: str) -> DataFrame | None:
    """A table with the batch of each row, or None before the first batch."""
    try:
        return spark.read.parquet(f"{folder}/{table}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def store_batch(batch: DataFrame, batch_id: int, folder: str, names: DataFrame | None = None) -> None:
    """Write what is new in the batch to the part `batch=<id>` of each table.

    New are contents that no earlier batch has.  The part is replaced in whole, so a batch that is run again (after a
    lost driver, say) leaves the same tables; documents are written last.
    """
    known = stored(batch.sparkSession, folder, "documents")
    fresh = batch
    if known is not None:
        earlier = known.where(F.col("batch") < batch_id).select(F.col("doc_id").alias("_known")).distinct()
        fresh = batch.join(earlier, F.sha2("content", 256) == F.col("_known"), "left_anti")
    tables = doc_store.parse(fresh, names)
    for table in reversed(doc_store.TABLES):
        tables[table].write.mode("overwrite").parquet(f"{folder}/{table}/batch={batch_id}")


def ingest(pages: DataFrame, folder: str, checkpoint: str, names: DataFrame | None = None):
    """A query that stores all there is of the stream pages(url, content, content_type, source_type, publisher,
    published_at, fetched_at), then stops; started again it goes on where it stopped."""
    writer = pages.writeStream.foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, folder, names))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
