"""Mixing sources to target weights, in DataFrame expressions only.

The token shares of the sources are raised to a power and normalised.  Bisection finds the largest
power (closest to the natural shares) at which the mixture has the target entropy, or the power
closest to uniform at which no source is repeated more often than allowed.  The weights are then
realised as block permutations under a token budget: each epoch of a source is a permutation of its
blocks of documents, epochs are taken whole, and the last is cut where the budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import WORD_BREAK, is_small, settle

#: Blocks of a source at most (beyond that they grow in size), so that they can be ordered in one task.
MOST_BLOCKS = 65_536
#: Documents of cut blocks are sent to all executors up to so many rows, else joined.
SMALL_ROWS = 200_000


def word_tokens(text_col: str) -> Column:
    """Words of a text; null: none."""
    t = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, WORD_BREAK))).cast("long")


def temper(shares: dict, power: float) -> dict:
    logs = {k: power * math.log(v) for k, v in shares.items()}
    top = max(logs.values())
    raw = {k: math.exp(v - top) for k, v in logs.items()}
    total = math.fsum(raw.values())
    return {k: v / total for k, v in raw.items()}


def entropy(weights: dict) -> float:
    """In bits."""
    return -math.fsum(w * math.log2(w) for w in weights.values() if w > 0)


def bisect_power(tokens: dict, *, target_entropy: float | None = None, max_repeat: float | None = None, steps: int = 60) -> tuple[float, dict]:
    """The power in [0, 1] and its weights.

    With max_repeat, the lowest power (flattest mixture) at which, when the source that is
    repeated least is used once, none is used more than max_repeat times.  With target_entropy,
    the highest power that reaches that entropy, 0 if none does.
    """
    if (target_entropy is None) == (max_repeat is None):
        raise ValueError("give a target entropy or a repetition limit")
    total = sum(tokens.values())
    shares = {k: v / total for k, v in tokens.items()}

    def enough(power: float) -> bool:
        w = temper(shares, power)
        if target_entropy is not None:
            return entropy(w) >= target_entropy
        rates = [w[k] / shares[k] for k in w]
        return max(rates) <= max_repeat * min(rates) * (1 + 1e-12)

    low, high = 0.0, 1.0
    if target_entropy is not None:
        if enough(1.0):
            return 1.0, shares
        if not enough(0.0):
            return 0.0, temper(shares, 0.0)
        for _ in range(steps):
            mid = (low + high) / 2
            low, high = (mid, high) if enough(mid) else (low, mid)
        return low, temper(shares, low)
    if enough(0.0):
        return 0.0, temper(shares, 0.0)
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if enough(mid) else (mid, high)
    return high, temper(shares, high)


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", tokens: Column | None = None, *, max_repeat: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None, block_tokens: int = 200_000, seed: int = 17, carry: tuple[str, ...] = ()) -> DataFrame:
    """Draw documents so that sources get their tempered weights.

    Returns one row per drawn copy: id_col, source_col, n_tokens, epoch (0, 1, ...), block,
    position (0 to 1: sort by it for a mixture that keeps its weights throughout) and the columns
    named in carry.  Without a budget it is the smallest at which every document is drawn at least
    once.  A source's share differs from its weight by less than a document.

    Counts per source and per block of a source (MOST_BLOCKS at most) are all that is ordered; the cut
    within the last block orders only that block's documents.  A source of any size
    is thus spread over tasks.  The table of sources reaches the driver.  Null is a source of its
    own; texts without tokens go along with their block; repeated rows are drawn like others, in a
    defined order only if their ids differ; an empty table gives no rows.  Columns in carry that are
    named like an output raise ValueError.
    """
    n = word_tokens("text") if tokens is None else tokens
    keep = [c for c in carry if c not in (id_col, source_col)]
    if clash := {"n_tokens", "epoch", "block", "position"}.intersection(keep):
        raise ValueError(f"columns named like an output: {sorted(clash)}")
    rows = df.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), n.alias("_n"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)))
    light = settle(rows.select("_id", "_src", "_n"))  # texts are read and counted once
    rows = rows if keep else light
    stats = {r["_src"]: (r["t"], r["d"]) for r in light.groupBy("_src").agg(F.sum("_n").alias("t"), F.count("*").alias("d")).collect()}
    have = {k: t for k, (t, _) in stats.items() if t > 0}
    types = dict(df.dtypes)
    kinds = {"id": types[id_col], "src": types[source_col]}
    if not have:
        one = rows.select(F.col("_id").alias(id_col), F.col("_src").alias(source_col), F.col("_n").alias("n_tokens"), F.lit(0).cast("long").alias("epoch"), F.lit(0).cast("long").alias("block"), F.lit(0.0).alias("position"), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)))
        return one
    _, weights = bisect_power(have, target_entropy=target_entropy, max_repeat=max_repeat if target_entropy is None else None)
    whole = max(math.ceil(have[k] / weights[k]) for k in have) if budget is None else budget
    plan = []
    for k, (t, _) in stats.items():
        want = max(t, round(weights[k] * whole)) if budget is None and t else round(weights.get(k, 0.0) * whole)
        epochs, rest = divmod(want, t) if t else (1, 0)
        plan.append((k, t, want, epochs, rest, min(MOST_BLOCKS, max(1, t // block_tokens))))
    spark = df.sparkSession
    plans = F.broadcast(spark.createDataFrame(plan, f"_src {kinds['src']}, _t long, _want long, _epochs long, _rest long, _blocks long"))

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.join(plans, frame["_src"].eqNullSafe(plans["_src"])).drop(plans["_src"]).withColumn("_b", F.pmod(F.xxhash64(F.lit(seed), "_id"), F.col("_blocks")))

    # the last, partial epoch: blocks in order of a hash until the rest is used up
    per_block = dealt(light.where(F.col("_n") > 0)).where("_rest > 0").groupBy("_src", "_b").agg(F.sum("_n").alias("_bt"), F.first("_rest").alias("_rest"), F.first("_epochs").alias("_epochs"))
    order = Window.partitionBy("_src").orderBy(F.xxhash64(F.lit(seed), "_epochs", "_b"), "_b")
    blocks = per_block.withColumn("_until", F.sum("_bt").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_left", F.col("_rest") - (F.col("_until") - F.col("_bt"))).where("_left > 0").select("_src", "_b", "_bt", "_left")
    blocks = settle(blocks)
    full = blocks.where("_left >= _bt").select("_src", F.col("_b").alias("_fb"))
    cut = blocks.where("_left < _bt").select("_src", F.col("_b").alias("_cb"), "_left")
    cuts = F.broadcast(cut)  # one block of each source at most
    within = dealt(light.where(F.col("_n") > 0))
    within = within.join(cuts, within["_src"].eqNullSafe(cuts["_src"]) & (within["_b"] == cuts["_cb"])).drop(cuts["_src"])
    inner = Window.partitionBy("_src").orderBy(F.xxhash64(F.lit(seed + 1), "_epochs", "_id"), "_id")
    taken = within.withColumn("_before", F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).where("_before < _left").select(F.col("_src").alias("_ts"), F.col("_id").alias("_ti")).distinct()
    return _realise(dealt(rows), full, taken, id_col, source_col, keep, seed)


def _realise(rows: DataFrame, full: DataFrame, taken: DataFrame, id_col: str, source_col: str, keep: list[str], seed: int) -> DataFrame:
    """Whole epochs, and those of the partial one that lie in a full block or in the used part of the cut one."""
    full = full.withColumnRenamed("_src", "_fs").withColumn("_whole", F.lit(True))
    taken = taken.withColumn("_part", F.lit(True))
    out = rows.join(full, rows["_src"].eqNullSafe(full["_fs"]) & (rows["_b"] == full["_fb"]), "left")
    taken = F.broadcast(taken) if is_small(taken, SMALL_ROWS) else taken
    out = out.join(taken, out["_src"].eqNullSafe(taken["_ts"]) & out["_id"].eqNullSafe(taken["_ti"]), "left")
    copies = (F.col("_epochs") + F.when(F.col("_whole") | F.col("_part"), 1).otherwise(0)).cast("int")
    out = out.withColumn("_copies", copies).where("_copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).withColumn("_epoch", F.col("_epoch").cast("long"))
    # a place within the epoch: the block's, then the document's; hashes stand for uniform numbers
    unit = lambda *c: F.shiftrightunsigned(F.xxhash64(F.lit(seed), *c), 11) / F.lit(float(1 << 53))
    place = F.col("_epoch") + (F.pmod(F.xxhash64(F.lit(seed), "_epoch", "_b"), F.lit(1 << 20)) + unit("_id", "_epoch")) / F.lit(float(1 << 20))
    position = F.when(F.col("_want") > 0, F.least(F.lit(1.0), place * F.col("_t") / F.col("_want"))).otherwise(F.lit(0.0))
    return out.select(F.col("_id").alias(id_col), F.col("_src").alias(source_col), F.col("_n").alias("n_tokens"), F.col("_epoch").alias("epoch"), F.col("_b").alias("block"), position.alias("position"), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)))
