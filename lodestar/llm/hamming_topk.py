"""Exact top-k search of 64-bit codes by incremental multi-index hashing.

Codes are cut into segments, fewer and wider ones for very many codes, each an index from segment value to codes.  In ring r, a query looks up
all values that differ from its own in exactly r bits, segment by segment, and what it finds is
verified by the full distance.  Two codes of distance d agree in some segment up to d // segments
bits, so after ring r everything nearer than segments * (r + 1) is known, and a query whose k-th
verified distance is covered by that leaves the search.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import settle

BITS = 64


def sign_code(vector: Column) -> Column:
    """Signs of the first 64 components as bits; missing, null and NaN components count as 0 bits, a
    null vector has no code."""
    bits = F.transform(F.slice(vector, 1, BITS), lambda x, i: F.when((x > 0) & ~F.isnan(x.cast("double")), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def cuts(count: int) -> list[tuple[int, int]]:
    """First bit and width of each segment: four of 16 bits, and fewer, wider ones where so many codes would share
    a value that looking them up costs more than the additional probes."""
    n = 4 if count < 1 << 22 else 3 if count < 1 << 28 else 2
    edges = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def segments_of(code: Column, parts: list[tuple[int, int]]) -> Column:
    """seg, value of all segments of a code, as an array."""
    value = lambda a, w: F.call_function("shiftrightunsigned", code, F.lit(a)).bitwiseAND(F.lit((1 << w) - 1).cast("long"))
    return F.array(*(F.struct(F.lit(i).alias("seg"), value(a, w).alias("value")) for i, (a, w) in enumerate(parts)))


def masks(width: int, r: int) -> Column:
    """All numbers of `width` bits, r of them set."""
    text = ",".join(str(sum(1 << b for b in bits)) for bits in combinations(range(width), r))
    return F.split(F.lit(text), ",").cast("array<bigint>") if text else F.array().cast("array<bigint>")


def top_k(df: DataFrame, id_col: str, code_col: str, *, k: int = 10, every: int = 20, per_task: int = 200) -> DataFrame:
    """The k nearest other rows of every row whose id is divisible by `every`; returns query_id, rank
    (from 1), neighbor_id, distance.  Order: distance, then id.

    Works on distinct codes: of the copies of one code only the k + 1 smallest ids matter, which are
    ranked before the shuffle.  Rows without id or code are left out; with fewer than k other rows all
    are returned; rows that share id and code are one.  Ids are whole numbers (else ValueError).  A task
    probes for per_task queries, about.
    """
    if dict(df.dtypes)[id_col] not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"{id_col} must hold whole numbers")
    rows = df.select(F.col(id_col).alias("id"), F.col(code_col).cast("long").alias("code")).where("id is not null and code is not null").distinct()
    need = k + 1  # the query itself is among what is found
    first = Window.partitionBy("code").orderBy("id")
    codes = settle(rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= need).groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    light = codes.select("code", F.size("ids").alias("n"), F.col("ids")[0].alias("least"))
    parts = cuts(light.count())
    segments, width = len(parts), max(w for _, w in parts)
    index = light.select("code", "n", "least", F.explode(segments_of(F.col("code"), parts)).alias("x")).select("code", "n", "least", "x.seg", "x.value")
    queries = rows.where(F.col("id") % every == 0)
    active = settle(queries.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(BITS)))
    best = found = None
    nearest = Window.partitionBy("q").orderBy("distance", "least", "code")
    for r in range(width + 1):
        # written again, so that what the join sees is no shuffle of few rows that it would send to the driver
        n = active.count() // per_task
        spread = settle(active.repartition(n, "q")) if n > 1 else active
        near = F.element_at(F.array(*(masks(w, r) for _, w in parts)), F.col("x.seg") + 1)
        probes = spread.select("q", "bound", F.explode(segments_of(F.col("q"), parts)).alias("x")).select("q", "bound", "x.seg", "x.value", F.explode(near).alias("mask"))
        probes = probes.select("q", "bound", "seg", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        met = probes.join(index, ["seg", "value"]).where(distance <= F.col("bound")).select("q", "code", "n", "least", distance.cast("int").alias("distance"))
        if best is not None:
            met = met.unionByName(best.join(active.select("q"), "q", "left_semi"))
        # of codes at equal distance the least ids decide, so k + 1 codes are kept, however many copies each has
        top = met.distinct().withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= need).withColumn("_until", F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, 0)))
        best = settle(top.drop("_n"))
        state = active.select("q").join(best.where(F.col("_until") >= need).groupBy("q").agg(F.min("distance").alias("far")), "q", "left").withColumn("bound", F.coalesce("far", F.lit(BITS)))
        best = best.drop("_until")
        covered = segments * (r + 1) - 1
        active = settle(state.where(F.col("bound") > min(covered, BITS - 1 if r < width else BITS)).select("q", "bound"))
        over = best.join(active, "q", "left_anti")
        found = over if found is None else found.unionByName(over)
        if r == width or not active.limit(1).count():
            break
    full = found.join(codes.select("code", "ids"), "code").select("q", "distance", F.explode("ids").alias("neighbor_id"))
    order = Window.partitionBy("q").orderBy("distance", "neighbor_id")
    # copies of a query's code share one list of k + 1; each drops itself or the last
    short = full.withColumn("n", F.row_number().over(order)).where(F.col("n") <= need).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("list"))
    mine = queries.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(short, "q")
    others = F.slice(F.filter("list", lambda x: x["neighbor_id"] != F.col("query_id")), 1, k)
    return mine.select("query_id", F.posexplode(others).alias("pos", "x")).select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.neighbor_id").alias("neighbor_id"), F.col("x.distance").alias("distance"))
