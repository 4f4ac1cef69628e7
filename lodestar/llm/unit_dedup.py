"""Substring dedup by hashing units of text.

Units are lines, and the sentences of a line.  A unit is normalised (lower case, white space runs made
one blank) and digested; digests are grouped over the corpus; the occurrence with the smallest
(document, offset) stays and the others are repeats.  A line that isn't a repeat as a whole can still
hold sentences that are.  Repeats that touch are one passage, and a passage goes if it is long enough,
so that a common heading or a short stock sentence alone costs no document anything.  Spans are kept
as offsets in the original text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SENTENCE_END = re.compile(r"[.!?]\s+")

#: A digest that more than 1 / HOT of the sampled documents hold is dealt out in parts.
HOT, SAMPLE = 500, 20_000
#: Rows of such a digest that a part should hold, about.
PART_ROWS = 50_000


def units(text: str, min_line_words: int, min_sentence_words: int) -> list[tuple[int, int, int, int, int]]:
    """(start, end, line's start, kind, 128-bit digest); kind 0 is a line, 1 a sentence of a longer
    line.  Lines end at \\n, sentences at . ! or ? before white space."""
    out, at, digest = [], 0, xxhash.xxh3_128_intdigest
    for body in text.split("\n"):
        cuts = [m.end() for m in SENTENCE_END.finditer(body)]
        if cuts and cuts[-1] == len(body):
            cuts.pop()
        begins = [0, *cuts]
        words = [body[a:b].lower().split() for a, b in zip(begins, [*cuts, len(body)], strict=True)]
        n = sum(map(len, words))
        if n >= min_line_words:
            norms = [" ".join(w) for w in words]
            out.append((at, at + len(body), at, 0, digest(b"l" + " ".join(norms).encode("utf-8", "surrogatepass"))))
            if cuts:
                for a, b, w, norm in zip(begins, [*cuts, len(body)], words, norms, strict=True):
                    if len(w) >= min_sentence_words:
                        out.append((at + a, at + b, at, 1, digest(b"s" + norm.encode("utf-8", "surrogatepass"))))
        at += len(body) + 1
    return out


def digest_table(df: DataFrame, id_col: str, text_col: str, min_line_words: int, min_sentence_words: int) -> DataFrame:
    """One row per row and distinct digest of its units: _i, h1, h2; rows that share an id can repeat some."""
    kind = dict(df.dtypes)[id_col]

    def cut(batches):
        for b in batches:
            rows, ids = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                found = {u[4] for u in units(t, min_line_words, min_sentence_words)}
                rows += found
                ids += [i] * len(found)
            both = np.frombuffer(b"".join([d.to_bytes(16, "little") for d in rows]), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["_i", "h1", "h2"])

    return df.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).where(F.col("_i").isNotNull() & F.col("_t").isNotNull()).mapInArrow(cut, f"_i {kind}, h1 long, h2 long")


def repeats(df: DataFrame, id_col: str, text_col: str, *limits: int) -> DataFrame:
    """Digests that a document shares with one of a smaller id: _i, h1, h2.

    One shuffle of digests, ranked by id within each; rows that share an id share the rank, so the smallest
    id keeps its units in all of them.  So that a digest of very many documents isn't
    one task's work, digests that are frequent among some documents (drawn by hash; which ones are
    drawn changes no result) are ranked in parts first, and only the first of each part goes on.
    """
    found = digest_table(df, id_col, text_col, *limits)
    count = df.count()
    rate, salts = max(1, count // SAMPLE), max(16, count // PART_ROWS)
    drawn = df.where(F.pmod(F.xxhash64(id_col), F.lit(rate)) == 0)
    least = max(50, SAMPLE // HOT)
    hot = digest_table(drawn, id_col, text_col, *limits).groupBy("h1", "h2").count().where(F.col("count") >= least)
    common = hot.orderBy(F.desc("count"), "h1", "h2").limit(SAMPLE).select("h1", "h2").collect()
    order = lambda *by: Window.partitionBy("h1", "h2", *by).orderBy("_i")
    if not common:
        return found.withColumn("_n", F.dense_rank().over(order())).where("_n > 1").select("_i", "h1", "h2")
    few = F.broadcast(df.sparkSession.createDataFrame(common, "h1 long, h2 long").withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_i"), F.lit(salts)).cast("int")).otherwise(-1)
    ranked = found.join(few, ["h1", "h2"], "left").withColumn("_part", salt).withColumn("_n", F.dense_rank().over(order("_part")))
    firsts = ranked.where("_n = 1 and _part >= 0").withColumn("_n", F.dense_rank().over(order())).where("_n > 1")
    return ranked.where("_n > 1").select("_i", "h1", "h2").unionByName(firsts.select("_i", "h1", "h2"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_run_words: int = 25, min_line_words: int = 1, min_sentence_words: int = 1, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove repeated passages; returns id_col, text_col (what stays), n_removed (spans), removed_chars,
    removed (array of start, end: 0-based code points of the original, end excluded) and the columns
    named in carry.

    A passage is a run of repeated lines and sentences with nothing but white space between, of
    min_run_words words or more; the earliest occurrence of every unit stays.  A removed line goes
    with its line break.  Units shorter than min_line_words or min_sentence_words are never repeats.
    Null texts stay null, empty ones empty; a row with a null id loses only what it repeats itself; rows that
    share an id count as one document, and each loses what a smaller id has or it repeats itself, so of rows
    that are alike every one keeps what no smaller id has.  Ids order documents, offsets order units
    within one.  Columns in carry that are named like an output raise ValueError.
    """
    keep = [c for c in carry if c not in (id_col, text_col)]
    if taken := {"n_removed", "removed_chars", "removed"}.intersection(keep):
        raise ValueError(f"columns named like an output: {sorted(taken)}")
    limits = (min_line_words, min_sentence_words)
    gone = repeats(df.select(id_col, text_col), id_col, text_col, *limits).groupBy("_i").agg(F.collect_set(F.struct("h1", "h2")).alias("_s"))
    types = dict(df.dtypes)
    rows = df.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)))
    joined = rows.join(gone, rows["_d"] == gone["_i"], "left").drop("_i")
    schema = f"`{id_col}` {types[id_col]}, `{text_col}` string, n_removed int, removed_chars int, removed array<struct<start:int,end:int>>" + "".join(f", `{c}` {types[c]}" for c in keep)
    head = [id_col, text_col, "n_removed", "removed_chars", "removed", *keep]

    def strip(batches):
        struct = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("end", pa.int32())]))
        for b in batches:
            texts, sets = b.column(1).to_pylist(), b.column(b.num_columns - 1)
            out, removed = [], []
            for i, t in enumerate(texts):
                s = sets[i]
                known = set() if not s.is_valid else {(r["h1"] % (1 << 64)) | (r["h2"] % (1 << 64)) << 64 for r in s.as_py()}
                spans = merged(t, units(t, *limits), known, min_run_words) if t else []
                out.append(without(t, spans) if spans else t)
                removed.append(spans)
            n = [len(r) for r in removed]
            chars = [sum(e - s for s, e in r) for r in removed]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(n, pa.int32()), pa.array(chars, pa.int32()), pa.array([[{"start": s, "end": e} for s, e in r] for r in removed], struct), *(b.column(2 + i) for i in range(len(keep)))], names=head)

    return joined.mapInArrow(strip, schema)


def merged(text: str, found: list[tuple[int, int, int, int, int]], known: set[int], min_run_words: int) -> list[tuple[int, int]]:
    """Spans to cut: runs of units whose digest an earlier document has or that the text itself had before.
    Lines go with their break; sentences of lines that went are gone with them."""
    runs: list[tuple[int, int]] = []
    met, line_gone = set(known), -1
    for start, end, line, kind, digest in found:
        if digest not in met:
            met.add(digest)
            continue
        if kind == 0:
            line_gone = line
            end += end < len(text)
        elif line == line_gone:
            continue
        if runs and not text[runs[-1][1] : start].strip():
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return [(s, e) for s, e in runs if len(text[s:e].split()) >= min_run_words]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    return "".join([*out, text[at:]])
