"""MinHash near-duplicates with an LSH forest.

Signatures are sorted in several orders (trees), each by hashes of its own.  In a tree, the documents
that share the longest prefix stand next to each other, so every document's candidates are its
neighbours with a common prefix of MIN_DEPTH hashes at least; where many documents share that much,
sorting by the hashes that follow makes the region's depth grow by itself.  Candidates are confirmed
on the full shingle sets, and components of confirmed links are classes.

Neighbours alone lose pairs in a region of many documents.  All documents of such regions also go
through an exact prefix-filter join on their shingles, which names every pair that can reach the
threshold and isn't linked yet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import settle, text_slices, word_hashes, worker_cache
from lodestar.llm.components import components

#: Hashes that neighbours must share, and hashes that a tree sorts by.
MIN_DEPTH, DEPTH = 4, 8
#: Neighbours on either side that a document is compared with in each tree; all pairs of a region of
#: REACH + 1 rows are candidates, the rows of larger ones are crowded and joined exactly.
REACH = 4
#: Crowded documents whose shingles are counted for the order of the prefix filter, and shingles that
#: count as common; both only steer the work.
SAMPLE, COMMON = 20_000, 200_000
#: Pairs or links that a task takes on, at least.
PER_TASK = 20_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int):
    """For each text the sorted distinct 64-bit hashes of its shingles; of fewer words, of the whole sequence."""
    for lo, hi in text_slices(texts):
        h, ends = word_hashes(texts.slice(lo, hi - lo))
        x = rolled(h, size)
        for at, to in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            own = np.sort(x[at : to - size + 1] if to - at >= size else rolled(h[at:to], to - at))
            yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def rolled(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words."""
    if not size or len(h) < size:
        return np.zeros(0, dtype=np.uint64)
    x = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        x = x * MULTIPLIER + h[k : len(h) - size + 1 + k]
    return mixed(x)


def coefficients(trees: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    n = trees * MIN_DEPTH
    return r.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(df: DataFrame, id_col: str, text_col: str, shingle: int, trees: int, seed: int) -> DataFrame:
    """_i, n (set size), d1 and d2 (digest of the set), sig (big-endian hashes, 4 bytes each)."""
    kind = dict(df.dtypes)[id_col]
    mul, add = coefficients(trees, seed)

    def run(batches):
        worker_cache("near_dups")  # what an earlier stage kept in this worker goes
        for b in batches:
            n, d1, d2, sig = [], [], [], []
            for x in shingle_sets(b.column(1), shingle):
                d = xxhash.xxh3_128_digest(x.tobytes())
                n.append(len(x))
                d1.append(int.from_bytes(d[:8], "little", signed=True))
                d2.append(int.from_bytes(d[8:], "little", signed=True))
                least = np.full(len(mul), 0xFFFFFFFF, dtype=np.uint64)
                for at in range(0, len(x), 4096):  # bounded memory for a text of any length
                    least = np.minimum(least, ((x[at : at + 4096, None] * mul + add) >> np.uint64(32)).min(axis=0))
                sig.append(least.astype(">u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary())], names=["_i", "n", "d1", "d2", "sig"])

    return df.select(F.col(id_col).alias("_i"), F.col(text_col)).mapInArrow(run, f"_i {kind}, n long, d1 long, d2 long, sig binary")


def neighbours(reps: DataFrame, trees: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs a < b with the number of trees that name them (votes).

    The rows of all trees are sorted as one table, dealt out by ranges of (tree, signature, id), so a
    region of any size spreads over tasks; pairs across a border between two ranges are found from
    the rows at the ends of each.  Also the ids of crowded rows, those of regions of more than REACH + 1.
    """
    kind = dict(reps.dtypes)["_i"]
    step, width = 4 * MIN_DEPTH, 4 * DEPTH
    wide = F.concat("sig", F.substring("sig", 1, width))
    tree = F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.substring(F.col("_w"), t * step + 1, F.lit(width)).alias("key"))))
    rows = reps.select("_i", wide.alias("_w")).select("_i", tree.alias("_k")).select(F.col("_k.tree").alias("tree"), F.col("_k.key").alias("key"), "_i")
    ordered = rows.repartitionByRange("tree", "key", "_i").sortWithinPartitions("tree", "key", "_i")
    names = ["a", "b", "part", "place", "tree", "key"]

    def run(batches):
        worker_cache("near_dups")  # what an earlier stage kept in this worker goes
        part, first, last = TaskContext.get().partitionId(), [], []
        table = None
        for b in batches:
            if not b.num_rows:
                continue
            if len(first) <= REACH:
                first += b.slice(0, REACH + 1 - len(first)).to_pylist()
            now = pa.Table.from_batches([b])
            joined = now if table is None else pa.concat_tables([table, now])
            ids = joined.column("_i").combine_chunks()
            trees_, keys = joined.column("tree").to_numpy(), joined.column("key").to_pylist()
            heads = np.frombuffer(b"".join(k[:step] for k in keys), dtype=np.dtype((np.void, step)))
            old = 0 if table is None else table.num_rows
            for d in range(1, REACH + 2):
                if len(ids) > d:
                    hit = np.flatnonzero((heads[d:] == heads[:-d]) & (trees_[d:] == trees_[:-d]) & (np.arange(d, len(ids)) >= old))
                    if d > REACH:  # a row with REACH + 1 others behind it: all of them are crowded
                        hit = np.unique(hit[:, None] + np.arange(d + 1))
                        none = pa.nulls(len(hit), pa.int32())
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(hit)), pa.nulls(len(hit), ids.type), none, none, none, pa.nulls(len(hit), pa.binary())], names=names)
                    elif len(hit):
                        none = pa.nulls(len(hit), pa.int32())
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(hit)), ids.take(pa.array(hit + d)), none, none, none, pa.nulls(len(hit), pa.binary())], names=names)
            table = joined.slice(max(0, joined.num_rows - REACH - 1))
        if table is not None:
            last = table.to_pylist()
            ends = [(r, k) for k, r in enumerate(first)] + [(r, 1000 + k) for k, r in enumerate(last)]
            yield pa.RecordBatch.from_arrays([pa.array([r["_i"] for r, _ in ends], ids.type), pa.nulls(len(ends), ids.type), pa.array([part] * len(ends), pa.int32()), pa.array([k for _, k in ends], pa.int32()), pa.array([r["tree"] for r, _ in ends], pa.int32()), pa.array([r["key"] for r, _ in ends], pa.binary())], names=names)

    found = settle(ordered.mapInArrow(run, f"a {kind}, b {kind}, part int, place int, tree int, key binary"))
    inner = found.where("part is null and b is not null").select("a", "b")
    # a row may be among the first and the last of a small range: the table of ends is distinct by row
    ends = found.where("part is not null").select("tree", "key", F.col("a").alias("_i")).distinct()
    order = Window.partitionBy("tree", F.substring("key", 1, step)).orderBy("key", "_i")
    border = [ends.select("_i", F.lead("_i", d).over(order).alias("b")).where("b is not null").select(F.col("_i").alias("a"), "b") for d in range(1, REACH + 1)]
    for more in border:
        inner = inner.unionByName(more)
    run_of = F.collect_list("_i").over(order.rowsBetween(0, REACH + 1))
    across = ends.select(run_of.alias("_r")).where(F.size("_r") > REACH + 1).select(F.explode("_r").alias("_i"))
    crowded = found.where("part is null and b is null").select(F.col("a").alias("_i")).unionByName(across).distinct()
    return inner.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).groupBy("a", "b").agg(F.count("*").alias("votes")), crowded


def shingle_rows(texts: DataFrame, shingle: int, percent: int | None, common: np.ndarray) -> DataFrame:
    """_i, n (set size), at (place in the set's order), s (shingle) of the texts _i, _t: of each set the
    prefix that a partner must meet, or with percent None all.  The order is the same for all sets:
    first shingles that aren't common, by hash, then the common ones, rarest first.
    """
    kind = dict(texts.dtypes)["_i"]
    by_hash = np.argsort(common)
    sent = texts.sparkSession.sparkContext.broadcast((common[by_hash], by_hash))

    def run(batches):
        worker_cache("near_dups")  # what an earlier stage kept in this worker goes
        hashes, rank = sent.value
        for b in batches:
            for i, x in enumerate(shingle_sets(b.column(1), shingle)):
                if not len(x):
                    continue
                n = len(x)
                if percent is not None:
                    if len(hashes):
                        place = np.minimum(np.searchsorted(hashes, x), len(hashes) - 1)
                        x = x[np.argsort(np.where(hashes[place] == x, rank[place] + 1, 0), kind="stable")]
                    x = x[: n - -(-percent * n // 100) + 1]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.full(len(x), i))), pa.array(np.full(len(x), n, dtype=np.int32)), pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x.view(np.int64))], names=["_i", "n", "at", "s"])

    return texts.select("_i", "_t").mapInArrow(run, f"_i {kind}, n int, at int, s long")


def crowded_pairs(crowded: DataFrame, texts: DataFrame, of: DataFrame, shingle: int, percent: int) -> DataFrame:
    """All pairs a < b of crowded documents that aren't in one component of `of` and can share percent of
    their shingles.

    Two such sets meet within the prefixes of one order, and from the place where they first meet, what
    follows in either must still hold the overlap.  Shingles whose documents are all linked already name
    nothing, so a group of near-duplicates costs no pairs of its own.
    """
    some = settle(texts.join(crowded, "_i"), PER_TASK)
    rate = max(1, some.count() // SAMPLE)
    drawn = some.where(F.pmod(F.xxhash64("_i"), F.lit(rate)) == 0)
    counts = shingle_rows(drawn, shingle, None, np.zeros(0, dtype=np.uint64)).groupBy("s").count().where("count > 2")
    top = counts.orderBy(F.desc("count"), "s").limit(COMMON).select("s").collect()
    common = np.array([r["s"] for r in reversed(top)], dtype=np.int64).view(np.uint64)
    rows = shingle_rows(some, shingle, percent, common).join(of.select(F.col("node").alias("_i"), "component"), "_i", "left")
    rows = settle(rows.withColumn("c", F.coalesce("component", "_i")).drop("component"))
    mixed_ = rows.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("s")
    left = settle(rows.join(mixed_, "s"), 10 * PER_TASK)
    a, b = (left.select("s", *(F.col(x).alias(f"{x}_{side}") for x in ("_i", "n", "at", "c"))) for side in "ab")
    enough = (100 + percent) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= percent * (F.col("n_a") + F.col("n_b"))
    met = a.join(b, (a["s"] == b["s"]) & (F.col("c_a") < F.col("c_b")) & enough)
    return met.select(F.least("_i_a", "_i_b").alias("a"), F.greatest("_i_a", "_i_b").alias("b")).where("a != b").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those pairs a, b whose full sets overlap: 100 * intersection >= percent * union."""
    kind = dict(pairs.dtypes)["a"]
    one = pairs.join(texts.select(F.col("_i").alias("a"), F.col("_t").alias("ta")), "a")
    both = one.join(texts.select(F.col("_i").alias("b"), F.col("_t").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        worker_cache("near_dups")  # what an earlier stage kept in this worker goes
        for b in batches:
            keep, seconds = [], b.column(1).to_pylist()
            heads = [k for k in range(len(seconds)) if not k or seconds[k] != seconds[k - 1]]  # pairs of one b mostly follow each other
            others, of, head = shingle_sets(b.column(3).take(pa.array(heads, pa.int64())), shingle), None, set(heads)
            for k, x in enumerate(shingle_sets(b.column(2), shingle)):
                of = next(others) if k in head else of
                common = len(np.intersect1d(x, of, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(of) - common):
                    keep.append(k)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows)], names=["a", "b"])

    return both.mapInArrow(run, f"a {kind}, b {kind}")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4, percent: int = 80, trees: int = 20, seed: int = 5) -> DataFrame:
    """Classes of near-duplicates; returns id_col, n_shingles, component_id, kept.

    Documents of the same shingle set are one class from the start (no pairs among them); one of each
    set, its smallest id, enters the forest.  Two documents that share 80 % of their shingles are in
    no region together with a chance of (1 - 0.8 ** 4) ** 20 < 0.003 %.  First every document's most
    named candidate is confirmed, then only pairs whose ends aren't linked yet, so a large group costs
    a few confirmations a member.  Last, all pairs still open among documents of crowded regions are
    taken from an exact join, so how many others stand between two documents loses no link.

    Null and empty texts have 0 shingles and are linked with nothing.  A null id is in no class: its
    component is null and it's kept.  Rows that share an id are one document for links: any of their
    texts links them.
    """
    kind = dict(df.dtypes)[id_col]
    sigs = settle(signatures(df, id_col, text_col, shingle, trees, seed))
    sets = sigs.where("n > 0 and _i is not null").groupBy("d1", "d2").agg(F.min("_i").alias("_i"), F.first("sig").alias("sig"))
    reps = settle(sets, PER_TASK)
    texts = df.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    left, crowded = neighbours(reps, trees)
    left, crowded = settle(left, PER_TASK), settle(crowded, PER_TASK)
    ends = left.select(F.col("a").alias("node"), "a", "b", "votes").unionByName(left.select(F.col("b").alias("node"), "a", "b", "votes"))
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("votes", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    best = settle(best, PER_TASK)
    links = settle(confirmed(best, texts, shingle, percent), PER_TASK)
    of = settle(components(links), PER_TASK)
    rest = left.join(best, ["a", "b"], "left_anti").join(of.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(of.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    rest = settle(rest.where("not (ca <=> cb) or ca is null").select("a", "b"), PER_TASK)
    # what is linked so far goes on as stars, so the last round starts from short paths
    stars = lambda x: x.select(F.col("node").alias("a"), F.col("component").alias("b"))
    links = stars(of).unionByName(settle(confirmed(rest, texts, shingle, percent), PER_TASK))
    if not crowded.isEmpty():
        of = settle(components(links), PER_TASK)
        open_ = settle(crowded_pairs(crowded, texts, of, shingle, percent), PER_TASK)
        links = stars(of).unionByName(settle(confirmed(open_, texts, shingle, percent), PER_TASK))
    # rows of one id with several sets hold them together, and every document hangs on the smallest of its set
    same = sigs.where("n > 0 and _i is not null").join(reps.select("d1", "d2", F.col("_i").alias("r")), ["d1", "d2"])
    member = settle(same.select(F.col("_i").alias("a"), F.col("r").alias("b")).distinct(), PER_TASK)
    of = components(links.unionByName(member.where("a != b"))) if _shared(member) else None
    if of is None:
        top = components(links)
        out = member.join(top.select(F.col("node").alias("b"), "component"), "b", "left").select(F.col("a").alias("_m"), F.coalesce("component", "b").alias("_c"))
    else:
        out = of.select(F.col("node").alias("_m"), F.col("component").alias("_c"))
    rows = sigs.select("_i", "n").join(out, F.col("_i") == F.col("_m"), "left")
    component = F.coalesce("_c", "_i").cast(kind)
    return rows.select(F.col("_i").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("_i") == component, F.lit(True)).alias("kept"))


def _shared(member: DataFrame) -> bool:
    """Whether an id occurs with more than one set."""
    return bool(member.groupBy("a").count().where("count > 1").limit(1).count())
