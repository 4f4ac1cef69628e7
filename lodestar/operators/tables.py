"""Keyed writes as new table states: upserts, insert-if-absent, slowly changing rows, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.running import running_sums

FOREVER = "9999-12-31"


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], keep_old_if_null: tuple[str, ...] = (), order: list[Column] | None = None) -> DataFrame:
    """The state after incoming rows replace current ones of the same key.

    Of several incoming rows of a key the first by `order` counts.  Columns in keep_old_if_null keep the
    old value where the new one is null.
    """
    if order:
        incoming = incoming.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
    a, b = current.alias("a"), incoming.withColumn("_new", F.lit(True)).alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    pick = lambda c: F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")) if c in keys or c in keep_old_if_null else F.when(F.col("b._new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    joined = a.join(b, [c for c in on][0] if len(on) == 1 else _all(on), "full")
    return joined.select(*(pick(c).alias(c) for c in current.columns))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def insert_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows and those incoming ones (one per key) whose key is new."""
    new = incoming.dropDuplicates(keys).join(current.select(*keys).distinct(), keys, "left_anti")
    return current.unionByName(new.select(*current.columns))


def valid_ranges(events: DataFrame, key: str, start: str) -> DataFrame:
    """Slowly changing rows from starts: valid_to is the next start, the last row is active."""
    w = Window.partitionBy(key).orderBy(start)
    nxt = F.lead(start).over(w)
    return events.withColumn("valid_from", F.col(start)).withColumn("valid_to", nxt).withColumn("status", F.when(F.col("valid_to").isNull(), "active").otherwise("delisted"))


def close_ranges(ranges: DataFrame, key: str, closings: DataFrame) -> DataFrame:
    """Active rows of closings(key, end) end at the first of these after they began, and a row of zero length marks it;
    closings that find nothing open do nothing.  `securities.timeline` does this for whole logs of events."""
    open_ = ranges.where(F.col("valid_to").isNull()).select(key, "valid_from")
    ends = closings.select(key, F.col("end").alias("_end")).join(open_, key).where("_end > valid_from").groupBy(key).agg(F.min("_end").alias("_end"))
    hit = ranges.join(ends, key, "left")
    closed = F.col("_end").isNotNull() & F.col("valid_to").isNull()
    out = hit.withColumn("status", F.when(closed, "delisted").otherwise(F.col("status"))).withColumn("valid_to", F.when(closed, F.col("_end")).otherwise(F.col("valid_to")))
    mark = hit.where(closed).withColumn("valid_from", F.col("_end")).withColumn("valid_to", F.col("_end")).withColumn("status", F.lit("delisted"))
    return out.unionByName(mark).drop("_end")


def overlaps(ranges: DataFrame, key: str) -> DataFrame:
    """Ranges [valid_from, valid_to) that begin before an earlier one of the key has ended; empty ones never."""
    end = F.coalesce(F.col("valid_to").cast("timestamp"), F.lit(FOREVER).cast("timestamp"))
    rows = ranges.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    w = Window.partitionBy(key).orderBy("valid_from", end).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_far", F.max(end).over(w)).where(F.col("valid_from").cast("timestamp") < F.col("_far")).drop("_far")


def new_version(current: DataFrame, incoming: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """Incoming rows whose canonical JSON differs from the latest version of the key (or that are new)."""
    digest = F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(payload)))), 256)
    last = current.groupBy(key).agg(F.max_by("sha256", F.struct("captured_at", "sha256")).alias("_old"))
    return incoming.withColumn("sha256", digest).join(last, key, "left").where(~F.col("sha256").eqNullSafe(F.col("_old"))).drop("_old")


def reference_counts(objects: DataFrame, references: DataFrame) -> DataFrame:
    """Objects with the number of distinct references; a counter that can't run out of step."""
    n = references.groupBy("object_id").agg(F.countDistinct("reference_type", "entity_id").alias("refcount"))
    return objects.join(n, "object_id", "left").withColumn("refcount", F.coalesce("refcount", F.lit(0)))


def cleanup_candidates(counted: DataFrame, now: Column, max_age_days: int = 30, most: int = 0) -> DataFrame:
    """Objects referenced at most so often and not accessed for longer than that."""
    old = F.col("last_accessed").cast("timestamp") < now.cast("timestamp") - F.make_interval(days=F.lit(max_age_days))
    return counted.where((F.col("refcount") <= most) & old)


def storage_statistics(counted: DataFrame) -> DataFrame:
    """Totals per backend, and over all of them (backend null), in one pass."""
    return counted.rollup("backend_type").agg(F.count("*").alias("objects"), F.sum("size_bytes").alias("bytes"), F.count_if(F.col("refcount") == 0).alias("unreferenced"))


def evictions(objects: DataFrame, by: str, capacity: int) -> DataFrame:
    """Objects to drop per `by`, oldest first, until what stays fits; no task holds all objects of one."""
    kept = running_sums(objects, [by], [F.desc("last_accessed"), F.desc("object_id")], {"_kept": F.col("size_bytes")})
    return kept.where(F.col("_kept") > capacity).drop("_kept")
