"""Mixture-controlled packing of documents into token windows.

Every source is a queue of tokens.  Deficit round-robin serves the queues in quanta: a source earns
service in proportion to its weight, is served when it has earned a quantum, and carries what is left
(its deficit) on, across windows and partitions.  With fixed weights that order has a closed form:
quantum i of source s is due at time (2i + 1) / w_s, and quanta are served as they fall due, ties by
source.  How many quanta of any source precede a given one is then whole-number arithmetic on the
weights, so every task finds the windows of its own documents alone, and no state passes between
tasks.  Windows are filled to the last token; only the last one is padded.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import is_small, settle, text_slices, worker_cache

END = 0
#: Weights are whole numbers of this sum or a little more.
WEIGHT_SUM = 1 << 20
#: Offsets of (partition, source) pairs are sent to all executors up to so many rows, else joined.
SMALL_ROWS = 200_000


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the
    others for the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)} | {b: chr(b) for b in plain}


#: Fixed value: how byte-level tokenizers cut a text before they merge.
BYTE_LEVEL_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of texts, as the file's tokenizer gives them.

    A byte-level vocabulary whose ids follow the order of its merges is run by a faster engine, built from
    the same file; any other goes through the tokenizer itself.  Nothing is remembered between texts.  A
    special token's letters in a text are plain text if special_as_text (what a text says can't then end
    a document), else that token, as in a plain call.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.size = self.tokenizer.get_vocab_size()
        self.fast = fast_engine(self.tokenizer)
        self.special = not special_as_text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, and END."""
        if self.fast is None:
            ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        elif self.special:
            ids = [self.fast.encode(t, allowed_special="all") for t in texts]
        else:
            ids = map(self.fast.encode_ordinary, texts)
        return [np.array([*x, END], dtype=np.uint32) for x in ids]


def fast_engine(tokenizer):
    """The tokenizer's twin for byte-level vocabularies, or None if the file says anything else."""
    import tiktoken

    file = json.loads(tokenizer.to_str())
    model, cut = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or file.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    byte_of = {c: b for b, c in byte_letters().items()}
    special = {a["content"]: a["id"] for a in file["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    merged = [ranks[bytes(byte_of[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
    if merged != sorted(merged) or len(merged) + 256 != len(ranks):
        return None
    return tiktoken.Encoding("twin", pat_str=BYTE_LEVEL_CUTS, mergeable_ranks=ranks, special_tokens=special)


def encoded(df: DataFrame, tokenizer_path: str, id_col: str, text_col: str, source_col: str, special_as_text: bool) -> DataFrame:
    """id, source, part, start (in the part's queue of the source), n, ids (little-endian, 4 bytes each, or 2
    where all ids fit)."""
    types = dict(df.dtypes)

    def run(batches):
        cache, part, queue, key = worker_cache("packing"), TaskContext.get().partitionId(), {}, (tokenizer_path, special_as_text)
        encoder = cache.get(key) or cache.setdefault(key, Encoder(*key))
        width = np.dtype("<u2") if encoder.size <= 1 << 16 else np.dtype("<u4")
        for b in batches:
            for at, to in text_slices(b.column(1)):
                ids = encoder.encode([t or "" for t in b.column(1).slice(at, to - at).to_pylist()])
                starts = []
                for s, x in zip(b.column(2).slice(at, to - at).to_pylist(), ids, strict=True):
                    starts.append(queue.get(s, 0))
                    queue[s] = starts[-1] + len(x)
                yield pa.RecordBatch.from_arrays([b.column(0)[at:to], b.column(2)[at:to], pa.array([part] * (to - at), pa.int32()), pa.array(starts, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype(width).tobytes() for x in ids], pa.binary())], names=["_id", "_src", "_part", "_start", "_n", "_ids"])

    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.col(source_col).alias("_src")).mapInArrow(run, f"_id {types[id_col]}, _src {types[source_col]}, _part int, _start long, _n long, _ids binary")


def whole_weights(tokens: list[int], targets: list[float] | None) -> list[int]:
    """Weights as whole numbers; the tokens themselves are the default target."""
    raw = [float(t) for t in tokens] if targets is None else [max(0.0, float(t)) for t in targets]
    total = sum(raw) or 1.0
    return [max(1, round(WEIGHT_SUM * r / total)) for r in raw]


def served_before(source: np.ndarray, quantum: np.ndarray, weights: list[int], tokens: list[int], size: int) -> np.ndarray:
    """Tokens served before quantum `quantum` of queue `source`, over all queues."""
    w = np.asarray(weights, dtype=np.int64)
    own = w[source]
    due = 2 * quantum + 1
    total = np.zeros(len(source), dtype=np.int64)
    for k, (wk, n) in enumerate(zip(weights, tokens, strict=True)):
        x = due * wk - own  # quantum i of k is due earlier if (2i + 1) own < due wk
        before = np.where(k < source, x // (2 * own) + 1, -((-x) // (2 * own)))  # ties go to the earlier source
        before = np.where(k == source, quantum, np.maximum(before, 0))
        total += np.minimum(before * size, n)
    return total


def cut_pieces(start: np.ndarray, n: np.ndarray, source: np.ndarray, weights: list[int], tokens: list[int], size: int, window: int) -> tuple[np.ndarray, ...]:
    """Pieces of documents that lie at `start` of their queues: (document, start in it, length, place)."""
    first, last = start // size, (start + n - 1) // size
    count = last - first + 1
    doc = np.repeat(np.arange(len(n)), count)
    quantum = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    begin = np.maximum(quantum * size, start[doc])
    end = np.minimum((quantum + 1) * size, (start + n)[doc])
    place = served_before(source[doc], quantum, weights, tokens, size) + begin - quantum * size
    # a quantum can lie across the end of a window if a queue's last one was short
    over = np.maximum(place + (end - begin) - (place // window + 1) * window, 0)
    cut = over > 0
    begin = np.concatenate([begin, (end - over)[cut]])
    place = np.concatenate([place, (place + (end - over) - begin[: len(end)])[cut]])
    length = np.concatenate([end - over - begin[: len(end)], over[cut]])
    doc = np.concatenate([doc, doc[cut]])
    order = np.lexsort((begin, doc))
    doc, begin, place, length = doc[order], begin[order], place[order], length[order]
    # neighbours that follow each other in the document and in the window are one piece
    joined = np.zeros(len(doc), dtype=bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + length[:-1]) & (place[1:] // window == place[:-1] // window)
    head = np.flatnonzero(~joined)
    return doc[head], begin[head] - start[doc[head]], np.add.reduceat(length, head) if len(head) else length, place[head]


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, window: int = 1024, quantum: int = 128, targets: dict | None = None, with_ids: bool = False, special_as_text: bool = True) -> DataFrame:
    """Pack all documents into windows; returns one row per piece: id_col, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, source_col (and ids, if asked for).  The letters of a special token in a
    text are plain text, as the tokenizers' guide sets it; special_as_text=False takes them for the token.

    A document's ids are its text's and one END.  Without targets (source -> weight) the sources' own
    token shares are the target, so that the mixture is the same from first to last window.  Where
    targets exhaust a queue early, the others share its place in proportion.  At every window's
    end a source is within a quantum of its due.  Null and empty texts are one END; a null source is
    a queue of its own; repeated rows are documents of their own; an empty table gives no rows.

    Ids are computed once and written to the checkpoint folder (2 bytes an id).  Token counts by
    source reach the driver; those by partition and source are summed by a window over them.
    """
    if window % quantum:
        raise ValueError("a window must be a whole number of quanta")
    spark, types = df.sparkSession, dict(df.dtypes)
    ids = settle(encoded(df, tokenizer_path, id_col, text_col, source_col, special_as_text))
    parts = ids.groupBy("_part", "_src").agg(F.sum("_n").alias("_t"))
    parts = settle(parts.withColumn("_base", F.sum("_t").over(Window.partitionBy("_src").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_t")))
    queues = sorted(((r["_src"], r["t"]) for r in parts.groupBy("_src").agg(F.sum("_t").alias("t")).collect()), key=lambda x: (x[0] is not None, str(x[0])))
    tokens = [t for _, t in queues]
    weights = whole_weights(tokens, None if targets is None else [targets.get(s, 0.0) for s, _ in queues])
    numbers = F.broadcast(spark.createDataFrame([(s, i) for i, (s, _) in enumerate(queues)], f"_src {types[source_col]}, _q int"))
    bases = parts.join(numbers, parts["_src"].eqNullSafe(numbers["_src"])).select(F.col("_part").alias("_p"), parts["_src"].alias("_s"), "_base", "_q")
    bases = F.broadcast(bases) if is_small(bases, SMALL_ROWS) else bases
    placed = ids.join(bases, (ids["_part"] == bases["_p"]) & ids["_src"].eqNullSafe(bases["_s"])).select("_id", "_src", (F.col("_start") + F.col("_base")).alias("_at"), "_n", "_q", "_ids")
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", source_col, *(["ids"] if with_ids else [])]
    schema = f"`{id_col}` {types[id_col]}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, `{source_col}` {types[source_col]}" + (", ids array<int>" if with_ids else "")

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            at, n, q = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4))
            doc, start, length, place = cut_pieces(at, n, q, weights, tokens, quantum, window)
            blobs, held, of, crc, lists = b.column(5), -1, None, np.zeros(len(doc), dtype=np.int64), []
            for k, (d, s, m) in enumerate(zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)):
                if d != held:
                    held, raw = d, blobs[d].as_py()
                    of = np.frombuffer(raw, dtype=f"<u{len(raw) // int(n[d])}").astype("<u4")
                crc[k] = zlib.crc32(of[s : s + m])
                if with_ids:
                    lists.append(of[s : s + m])
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), pa.array(start), pa.array(length), pa.array(crc), pa.array(n[doc]), pa.array(place // window), pa.array(place % window), b.column(1).take(rows), *([pa.array(lists, pa.list_(pa.int32()))] if with_ids else [])], names=names)

    return placed.mapInArrow(run, schema)
