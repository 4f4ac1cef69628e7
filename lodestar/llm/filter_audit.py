"""What filters do to each other: which order removes what, where, and at whose cost.

Every document fails some of five filters, a mask of five bits.  All that any order of the filters does
follows from how many documents have which mask, and these counts come from 32 signed sums: the sum
over documents of (-1) ** (failures within S), for every set S of filters.  Their Walsh-Hadamard
transform is its own inverse but for the factor 32, so the counts are exact.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import WHITE

FILTERS = "ABCDE"
#: The bit of the filter that asks for the whole table: an equal text of a smaller id.
COPY_BIT = 1 << FILTERS.index("E")
N_MASKS = 1 << len(FILTERS)


def failures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """_id, part, digest (SHA-256 of the text) and mask (filters A to D that the whole text fails, as bits)."""
    text = blanked = F.coalesce(F.col(text_col), F.lit(""))
    for c in WHITE[1:]:
        blanked = F.replace(blanked, F.lit(c), F.lit(" "))
    one = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("_t"), F.split(blanked, " ").alias("_w"))
    two = one.select("_id", "part", "_t", F.size(F.array_remove("_w", "")).alias("_n"), F.size(F.array_remove(F.array_distinct("_w"), "")).alias("_distinct"))
    capitals = F.length(F.regexp_replace("_t", "[^A-Z]+", ""))
    failed = (
        F.col("_n") < 200,
        F.lit(100) * F.col("_distinct") < F.lit(50) * F.col("_n"),
        F.lit(100) * capitals > F.lit(3) * F.length("_t"),
        reduce(Column.__or__, (F.col("_t").contains(c) for c in "#$%&*|")),
    )
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed)), F.lit(0))
    return two.select("_id", "part", F.unhex(F.sha2("_t", 256)).alias("digest"), mask.alias("mask"))


def masks(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", label_id: str = "doc_id") -> DataFrame:
    """part, good, toxic, mask, n: documents counted by part, label and mask of all five filters.

    Copies are found without bringing texts together: rows meet by id for their labels, then counts by
    digest, part, label and mask (a group of copies is a few rows by then), and only the smallest id of a
    digest isn't a copy.  Rows that share that id are all originals; a null id is neither copy nor original.
    """
    on = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("_id"))
    marked = on.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = failures(df, id_col, text_col, part_col).join(marked, "_id", "left").fillna(False, ["good", "toxic"])
    same = ["digest", "part", "good", "toxic", "mask"]
    by_id = rows.groupBy("_id", *same).agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct(F.col("_id"), F.col("n"))))
    groups = by_id.groupBy(*same).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"), first.alias("first"))
    least = F.min("first._id").over(Window.partitionBy("digest"))
    split = groups.withColumn("_least", least).withColumn("_kept", F.col("no_id") + F.when(F.col("first._id") == F.col("_least"), F.col("first.n")).otherwise(0))
    both = F.array(F.struct(F.col("mask"), F.col("_kept").alias("n")), F.struct((F.col("mask") + COPY_BIT).alias("mask"), (F.col("n") - F.col("_kept")).alias("n")))
    return split.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.mask", "x.n")


def sign(mask: Column, chosen: Column | int) -> Column:
    """-1 where the mask has an odd number of the chosen bits, else 1."""
    return 1 - 2 * (F.bit_count(mask.bitwiseAND(chosen)) % 2)


def parity_sums(counted: DataFrame) -> DataFrame:
    """sums: an array of the signed sums over all 32 sets of filters, per part and label."""
    sums = [F.sum(sign(F.col("mask"), s) * F.col("n")).alias(f"_{s}") for s in range(N_MASKS)]
    return counted.groupBy("part", "good", "toxic").agg(*sums).select("part", "good", "toxic", F.array(*(f"_{s}" for s in range(N_MASKS))).alias("sums"))


def cells(sums: DataFrame) -> DataFrame:
    """part, cells: for each part its 32 masks as (mask, n, good, toxic), from the inverted sums."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    back = F.transform(F.sequence(F.lit(0), F.lit(N_MASKS - 1)), lambda m: total(F.transform("sums", lambda v, s: v * sign(m, s))) / N_MASKS)
    long = sums.select("part", "good", "toxic", F.posexplode(back).alias("mask", "n")).withColumn("n", F.col("n").cast("long"))
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    by = long.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))
    return by.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 of them


def audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", label_id: str = "doc_id") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a row per
    part, order of the five filters and step.

    A null part is the part "", a null text is empty (it fails A, and E beside another empty text).  Repeated
    rows count each.  Labels of an id are taken together: good if one of them says so; labels that are null or
    of no document count for nothing.  Parts without documents don't appear, so an empty table gives no rows.
    Other columns of both tables are not read.
    """
    found = cells(parity_sums(masks(df, labels, id_col, text_col, part_col, label_id)))
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    bit_at = lambda k: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.substring("filter_order", k, 1)) - 1)
    every = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    earlier = lambda step: F.aggregate(every, F.lit(0), lambda a, k: a + F.when(k < step, bit_at(k)).otherwise(0))
    steps = F.transform(every, lambda k: F.struct(k.alias("step"), bit_at(k).alias("own"), earlier(k).alias("before")))
    rows = found.select("part", "cells", F.explode(orders).alias("filter_order")).select("part", "cells", "filter_order", F.explode(steps).alias("s")).select("*", "s.*")

    def count(keep, what: str = "n", weight=lambda m: F.lit(1)) -> Column:
        chosen = F.filter("cells", lambda c: keep(c["mask"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, c: a + c[what] * weight(c["mask"]))

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    here = lambda m: fails(m) & ~gone(m)
    # in each order one of a document's failures removes it, each of them equally often
    share = lambda m: F.floor(F.lit(120) / F.bit_count(m))
    return rows.select(
        "part",
        "filter_order",
        "step",
        count(lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        count(here).alias("removed"),
        count(lambda m: fails(m) & gone(m)).alias("redundant"),
        count(lambda m: m == F.col("own")).alias("unique_fails"),
        count(here, "good").alias("good_lost"),
        count(here, "toxic").alias("toxic_lost"),
        count(fails, weight=share).alias("shapley"),
    )
