"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of every contract: runs of anything but ASCII white space.
WORD_BREAK = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settle(df: DataFrame, per_task: int | None = None) -> DataFrame:
    """Write df to the checkpoint folder that the cluster shares and go on from there.

    The folder is the session's spark.checkpoint.dir.  Where that is unset, a single machine (tests) gets a
    temporary one and a cluster an error.  With per_task, what comes back has a partition for so many rows: after a
    shuffle of few rows over many partitions, the next ones then leave few files.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodestar-"))
    out = df.checkpoint(eager=True)
    return out if per_task is None else out.coalesce(max(4, out.count() // per_task))


def id_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def worker_cache(owner: str) -> dict:
    """A dict that lives as long as the Python worker (functions are shipped by value), or until another
    owner asks for one: workers are used again by later stages, whose memory it would take."""
    held = sys.__dict__.get("_lodestar_cache")
    if held is None or held[0] != owner:
        held = sys.__dict__["_lodestar_cache"] = (owner, {})
    return held[1]


def spread(text: Column, most: int, pieces: int = 16) -> Column:
    """The whole text where it has `most` characters at most, else as many in pieces from all over it, evenly apart."""
    size, own = F.length(text), most // pieces
    at = [F.substring(text, (F.lit(1) + F.floor((size - own) * F.lit(k / (pieces - 1)))).cast("int"), F.lit(own)) for k in range(pieces)]
    return F.when(size <= most, text).otherwise(F.concat_ws(" ", *at))


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether df has at most that many rows; reads no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows


#: Bytes of text that are split into words at once (or one text).
SLICE = 2 << 20
_STEP = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(41).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BYTES[65:91] = _BYTES[97:123]  # A to Z count as a to z
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _STEP and of its inverse modulo 2 ** 64, kept by the worker."""
    held = sys.__dict__.get("_lodestar_powers")
    if held is None or len(held[0]) < n:
        size = max(n, SLICE)
        held = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, dtype=np.uint64)])) for b in (_STEP, pow(_STEP, -1, 1 << 64)))
        if n <= SLICE:
            sys.__dict__["_lodestar_powers"] = held
    return held


def text_slices(texts: pa.Array):
    """Places lo, hi of runs of texts with SLICE bytes at most (or one text)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
        yield at, to
        at, done = to, int(ends[to - 1])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (A-Z lower-cased; null: none), and where each text's words
    end.  A word's hash is a sum over its bytes, weighted by powers, so no word becomes an object."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = _IN_WORD[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * power[:n], out=sums[1:])
    x = (sums[ends] - sums[starts]) * inverse[starts]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29)), np.searchsorted(starts, offsets[1:])
