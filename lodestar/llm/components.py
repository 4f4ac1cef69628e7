"""Connected components by alternating large and small stars; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import settle

#: Edges that a task of a round takes on, at least.
EDGES_PER_TASK = 50_000


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of the undirected edges a, b.

    Each round joins every node's neighbours with its least neighbour; minima are aggregated before
    the shuffle, and adaptive execution splits the edges of a hub.  The number of rounds grows with the
    logarithm of the longest path.  Each round's edges are written to the checkpoint folder.
    """
    now = settle(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while mark[0]:
        # few edges need few tasks, however many partitions a shuffle has; so each shuffle leaves few files
        few = lambda df, n=max(4, mark[0] // EDGES_PER_TASK): df.coalesce(n)
        one = few(now)
        both = one.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(one.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = few(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = few(large.join(low, "a")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(few(low).select("a", F.col("m").alias("b")))
        now = settle(few(small.distinct()))
        fresh = _mark(now)
        if fresh == mark:
            break
        mark = fresh
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart (and is the same for the same set)."""
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
    return tuple(r)
