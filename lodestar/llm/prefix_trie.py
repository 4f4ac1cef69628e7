"""A trie over the turns of conversations as a table of nodes in preorder.

Nodes are told apart by running fingerprints of their turns.  Sorted by the choices made at branchings, then
by depth, they stand in preorder: a subtree is an interval of positions.  With the interval's end stored, the
number of leaves in a subtree and the sum of anything over it are differences of running sums.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import settle

#: Turns of one conversation that a task holds together.
BLOCK = 1 << 16
#: Ids that are joined to one text before a node's digest is made.
PIECE = 4096
NODE = ["depth", "x", "y"]
NO_TEXT = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, ranges: list, order: list, **sums: Column) -> DataFrame:
    """df with position (1, 2, ... in the order) and running sums up to and with each row.

    Rows are sorted by range and written once; only the totals of ranges, a row each, meet in one place.
    `ranges` must follow from `order`: its columns, or prefixes of them.
    """
    placed = settle(df.repartitionByRange(*ranges).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    rows = placed.withColumn("_part", F.shiftright("_id", 33))
    totals = rows.groupBy("_part").agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_{k}") for k, c in sums.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_part", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in ("n", *sums)))
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *(F.sum(c).over(inside).alias(k) for k, c in sums.items())) if sums else rows
    out = local.join(F.broadcast(carried), "_part")  # one row for each partition
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1 + F.col("_n")
    return out.withColumn("position", place).withColumns({k: F.col(k) + F.col(f"_{k}") for k in sums}).drop("_id", "_part", "_n", *(f"_{k}" for k in sums))


def ordered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, place (1, 2, ... over all), digest, chars of the turns in the order of conversation and turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.concat(role, F.lit("\0"), text).alias("said"), F.length(role).alias("_r"), F.length(text).alias("chars"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.col("_r").cast("string"), F.lit(":"), F.col("said")), 256)), 1, 16)
    order = [F.col("conv"), F.asc_nulls_first("turn")]
    ranged = rows.repartitionByRange(*order, F.left("said", F.lit(48))).sortWithinPartitions(*order, "said")
    return _placed(ranged.select("conv", digest.alias("digest"), F.col("chars").cast("long").alias("chars")))


def _placed(ranged: DataFrame) -> DataFrame:
    """`place` of rows that are sorted by range already."""
    rows = settle(ranged.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_n"))
    return rows.join(F.broadcast(carried), "_part").withColumn("place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1 + F.col("_n")).drop("_id", "_part", "_n")


def rebuilt(turns: DataFrame, most: int = 6, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations as they share their beginnings, from the output of ordered_turns.

    Of conversation c, the first h = crc32(c) % most turns are those of conversation c - c % group (fewer where it is
    shorter, none where it isn't there), then come c's own turns after its first h.  Returns the turns (conv, depth,
    digest, chars, last) and the conversations that have none (conv).
    """
    convs = turns.groupBy("conv").agg(F.min("place").alias("start"), F.count("*").alias("own"))
    convs = convs.select("*", (F.col("conv") - F.col("conv") % group).alias("base"), (F.crc32(F.col("conv").cast("string")) % most).cast("int").alias("h"))
    at = (F.col("place") - F.col("start") + 1).alias("at")
    bases = turns.where(F.col("conv") % group == 0).join(convs.select("conv", "start"), "conv").select("conv", at, "digest", "chars").where(F.col("at") < most)
    heads = bases.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("at", "digest", "chars"))).alias("head"))  # most - 1 of them
    head = F.slice(F.coalesce("head", F.expr("array()")), F.lit(1), F.col("h"))
    info = convs.join(heads, "base", "left").select("conv", "start", "own", "h", head.alias("head"))
    info = settle(info.select("conv", "start", "h", "head", (F.size("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length")))
    given = info.select("conv", "length", F.explode("head").alias("t")).select("conv", F.col("t.at").alias("depth"), "t.digest", "t.chars", (F.col("t.at") == F.col("length")).alias("last"))
    own = turns.join(info, "conv").select("conv", "h", "head", "length", "digest", "chars", at).where(F.col("at") > F.col("h"))
    depth = F.col("at") - F.col("h") + F.size("head")
    kept = own.select("conv", depth.alias("depth"), "digest", "chars", (depth == F.col("length")).alias("last"))
    return given.unionByName(kept), info.where("length = 0").select("conv")


def fingerprints(turns: DataFrame) -> DataFrame:
    """turns (conv, depth, digest, chars, last) with x, y (of all turns up to this one) and px, py (up to the one
    before).  A turn's hashes hold its place, so they can be combined by exclusive or in any grouping: blocks
    of a long conversation are combined on their own and then chained."""
    rows = turns.select("*", F.xxhash64("depth", "digest").alias("hx"), F.xxhash64("digest", F.lit("y"), "depth").alias("hy"), F.floor(F.col("depth") / BLOCK).alias("block"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("hx").alias("bx"), F.bit_xor("hy").alias("by"))
    blocks = blocks.select("conv", "block", *(F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")).alias(c) for c in ("bx", "by")))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.join(blocks, ["conv", "block"])
    done = both.select("conv", "depth", "digest", "chars", "last", "hx", "hy", *(F.bit_xor(f"h{c}").over(inside).bitwiseXOR(F.col(f"b{c}")).alias(c) for c in "xy"))
    return done.select("conv", "depth", "digest", "chars", "last", "x", "y", F.col("x").bitwiseXOR(F.col("hx")).alias("px"), F.col("y").bitwiseXOR(F.col("hy")).alias("py"))


def branch_keys(rows: DataFrame) -> DataFrame:
    """depth, x, y, key: of each node, the turns chosen at branchings above it, from the rows of one conversation
    for each leaf (conv, depth, x, y, digest, branch).  A key is as long as the branchings are many, not as the path."""
    rows = rows.withColumn("block", F.floor(F.col("depth") / BLOCK))
    chosen = F.collect_list(F.when(F.col("branch"), F.struct("depth", "digest")))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.transform(F.array_sort(chosen), lambda t: t["digest"]).alias("own"))
    blocks = blocks.select("conv", "block", F.flatten(F.collect_list("own").over(before)).alias("above"))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = F.collect_list(F.when(F.col("branch"), F.col("digest"))).over(inside)
    keyed = rows.join(blocks, ["conv", "block"]).select(*NODE, F.concat("above", own).alias("key"))
    return keyed.groupBy(*NODE).agg(F.any_value("key").alias("key"))


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, x, y, ends_sha256: SHA-256 of the ids of each node's conversations that end there, in numeric order
    and joined by commas.

    Ids are sorted by range and joined to texts of 4,096 by all tasks.  A digest takes its bytes one after
    another, so a node's pieces then stream through one task, which holds one batch of them at a time.
    """

    def joined(batches):
        node, ids = None, []
        out = []

        def flush():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))
                ids.clear()

        def batch():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())], names=[*NODE, "first", "ids"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[:3] != node or len(ids) == PIECE:
                    flush()
                    node = row[:3]
                ids.append(row[3])
            if out:
                yield batch()
        flush()
        if out:
            yield batch()

    def hashed(batches):
        node, state = None, None
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[:3] != node:
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = row[:3], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row[4].encode())
            if out:
                yield _digest_batch(out)
        if state:
            yield _digest_batch([(*node, state.hexdigest())])

    schema = "depth bigint, x bigint, y bigint"
    ranged = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    pieces = ranged.mapInArrow(joined, f"{schema}, first bigint, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{schema}, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"])


def trie(turns: DataFrame, empty_convs: DataFrame) -> DataFrame:
    """Nodes of the trie over turns (conv, depth, digest, chars, last) and conversations without any (conv):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, position, end_position.

    Conversations are written once as fingerprints of all their beginnings.  What many share (the root, a common
    first turn) is counted before it is shuffled, or is the side of a join that adaptive execution splits.
    """
    long = lambda v: F.lit(v).cast("long")
    rows = settle(fingerprints(turns))
    at = rows.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.any_value("chars").alias("chars"), F.any_value("px").alias("px"), F.any_value("py").alias("py"))
    every = rows.where("last").select("conv").unionByName(empty_convs).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    root = every.select(long(0).alias("depth"), long(0).alias("x"), long(0).alias("y"), "n_convs", "conv_id", long(0).alias("chars"), long(None).alias("px"), long(None).alias("py"))
    at = at.unionByName(root)
    up = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    children = at.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    nodes = settle(at.join(children, NODE, "left").fillna(0, ["n_children"]).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).withColumn("leaf", (F.col("n_children") == 0).cast("long")))

    # one conversation for each leaf passes through all nodes
    leaves = nodes.where("leaf = 1 AND depth > 0").select(F.col("conv_id").alias("conv"))
    paths = rows.join(leaves, "conv", "left_semi").select("conv", *NODE, "digest", "px", "py")
    parents = nodes.where("n_children > 1").select(*(F.col(c).alias(f"p_{c}") for c in NODE))
    above = (F.col("depth") - 1 == F.col("p_depth")) & (F.col("px") == F.col("p_x")) & (F.col("py") == F.col("p_y"))
    marked = paths.join(parents, above, "left").select("conv", *NODE, "digest", F.col("p_depth").isNotNull().alias("branch"))
    keyed = nodes.join(branch_keys(marked), NODE, "left").withColumn("key", F.coalesce("key", F.expr("array()")))
    ranked = settle(running(keyed, ["key", "depth"], ["key", "depth"], leaves_to=F.col("leaf"), saved_to=F.col("saved")).drop("key"))

    # the last node of a subtree is a leaf
    ends = ranked.where("leaf = 1").select(F.col("conv_id").alias("conv"), F.struct("position", "leaves_to", "saved_to").alias("to"))
    far = paths.select("conv", *NODE).join(ends, "conv").groupBy(*NODE).agg(F.max("to").alias("to"))
    far = far.unionByName(ends.agg(F.max("to").alias("to")).select(long(0).alias("depth"), long(0).alias("x"), long(0).alias("y"), "to"))
    last = rows.where("last").select("conv", *NODE).unionByName(empty_convs.select("conv", *(long(0).alias(c) for c in NODE)))
    over = nodes.select(*(F.col(c).alias(f"p_{c}") for c in NODE), F.col("conv_id").alias("parent_conv_id"))
    out = ranked.join(far, NODE).join(end_digests(last), NODE, "left").join(over, above, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("to.leaves_to") - F.col("leaves_to") + F.col("leaf")).alias("n_leaves"),
        (F.col("to.saved_to") - F.col("saved_to") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_TEXT)).alias("ends_sha256"),
        "position",
        F.col("to.position").alias("end_position"),
    )


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, most: int = 6, group: int = 100) -> DataFrame:
    """The trie over rebuilt conversations; columns as of `trie`, all numbers long.

    Turns are in the order of their number, null first; turns of the same number in the order of role, then text.
    A null role or text is empty; rows without conversation are left out; repeated rows are turns of their own.  A
    conversation that is left without turns is a member of the root.  An empty table has no nodes, not even a root.
    Other columns are not read.
    """
    turns, bare = rebuilt(ordered_turns(df, conv_col, turn_col, role_col, text_col), most, group)
    return trie(turns, bare)
