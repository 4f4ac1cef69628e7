"""Quality classifier: a byte-level convolutional network in numpy.

A text is a run of bytes.  Learned filters look at windows of 8 bytes, every 4 bytes; their rectified
answers are averaged over chunks of 256 bytes that overlap by half and cover the whole text, then
max-pooled over all chunks and combined into one probability.  Every byte enters as a learned
embedding and one more channel that says whether the 6 bytes from here on were met up to 40 bytes
before (stutter), which no fixed filter could see.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import id_bucket, settle, spread

WIDTH, STRIDE, HALF, GRAM, LAGS, PAD = 8, 4, 128, 6, 40, 256
#: Bytes that are convolved at once: a bound on memory.
BLOCK_BYTES = 1 << 19


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each padded to whole half chunks with room for a window and the lags;
    the first half chunk of each; the window starts that lie within the text, by half chunk."""
    halves = np.array([max(1, -(-(len(t) + LAGS + GRAM + 2) // HALF)) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(halves)])
    buf = np.full(first[-1] * HALF + WIDTH, PAD, dtype=np.uint16)
    for t, f in zip(texts, first, strict=False):
        buf[f * HALF : f * HALF + len(t)] = np.frombuffer(t, dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    within = np.arange(first[-1]) - np.repeat(first[:-1], halves)
    valid = np.clip(-(-(np.repeat(lengths, halves) - within * HALF) // STRIDE), 0, HALF // STRIDE)
    return buf, first, valid


def stutter(buf: np.ndarray) -> np.ndarray:
    """Whether the bytes from a place on were met shortly before; never in the padding, which would tell of neighbours."""
    gram = np.zeros(len(buf), dtype=np.uint64)
    for k in range(GRAM):
        gram[: len(buf) - k] = gram[: len(buf) - k] * np.uint64(257) + buf[k:].astype(np.uint64)
    met = np.zeros(len(buf), dtype=bool)
    for lag in range(2, LAGS + 1):
        met[lag:] |= gram[lag:] == gram[:-lag]
    return met & (buf != PAD)


class Network:
    """Parameters and forward pass; `train` fits them with Adam."""

    def __init__(self, embedding: int = 6, filters: int = 20, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": (r.normal(size=(257, embedding)) * 0.5).astype(np.float32),
            "conv": (r.normal(size=(WIDTH * (embedding + 1), filters)) / np.sqrt(WIDTH * embedding)).astype(np.float32),
            "bias": np.zeros(filters, np.float32),
            "mix": (r.normal(size=filters) * 0.1).astype(np.float32),
            "mix_low": (r.normal(size=filters) * 0.1).astype(np.float32),
            "out": np.zeros(1, np.float32),
        }
        self.p["embed"][256] = 0

    def windows(self, buf: np.ndarray, met: np.ndarray) -> np.ndarray:
        x = np.concatenate([self.p["embed"][buf], met[:, None].astype(np.float32)], axis=1)
        n = (len(buf) - WIDTH) // STRIDE
        return np.lib.stride_tricks.as_strided(x, (n, WIDTH * x.shape[1]), (x.strides[0] * STRIDE, x.strides[1]))

    def sums(self, buf: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Sum of the rectified answers of the windows that begin in each half chunk.

        Works through the bytes in blocks, so memory is bounded for a text of any length; a block
        reads the half chunk before it too, as far as the stutter looks back."""
        out, per, step = [], HALF // STRIDE, BLOCK_BYTES // HALF
        for i in range(0, len(valid), step):
            j, back = min(i + step, len(valid)), min(i, 1)
            part = buf[(i - back) * HALF : j * HALF + WIDTH]
            ahead = buf[(i - back) * HALF : j * HALF + WIDTH + GRAM]
            x = self.windows(part, stutter(ahead)[: len(part)])[back * per :]
            a = np.maximum(np.ascontiguousarray(x) @ self.p["conv"] + self.p["bias"], 0)
            a = a.reshape(-1, per, a.shape[1])
            a *= (np.arange(per)[None, :] < valid[i:j, None])[:, :, None]
            out.append(a.sum(axis=1))
        return np.concatenate(out)

    def pooled(self, sums: np.ndarray, valid: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max and min over the chunks of each text; a chunk is a half chunk and the next, if any."""
        last = np.zeros(len(sums), dtype=bool)
        last[first[1:] - 1] = True
        nxt = np.where(last[:, None], 0, np.concatenate([sums[1:], sums[:1]]))
        more = np.where(last, 0, np.concatenate([valid[1:], valid[:1]]))
        n = valid + more
        mean = (sums + nxt) / np.maximum(n, 1)[:, None]
        # what holds under 64 bytes of a longer text is part of the chunk before it
        thin = (n < 16) & (np.arange(len(n)) != np.repeat(first[:-1], np.diff(first)))
        high = np.maximum.reduceat(np.where(thin[:, None], -1, mean), first[:-1], axis=0)
        low = np.minimum.reduceat(np.where(thin[:, None], np.inf, mean), first[:-1], axis=0)
        return high, low

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text."""
        buf, first, valid = layout(texts)
        high, low = self.pooled(self.sums(buf, valid), valid, first)
        return 1 / (1 + np.exp(-(high @ self.p["mix"] + low @ self.p["mix_low"] + self.p["out"]).astype(np.float64)))


def train(texts: list[bytes], labels: np.ndarray, *, steps: int = 260, batch: int = 48, chunks: int = 10, rate: float = 0.01, seed: int = 11, **size) -> Network:
    """Fit by Adam on the log loss.  Each step takes as many texts of either label and some of the chunks of each."""
    net, r = Network(**size), np.random.default_rng(seed)
    buf, first, valid = layout(texts)
    met, per = stutter(buf), HALF // STRIDE
    by = [np.flatnonzero(labels == k) for k in (0, 1)]
    if not len(by[0]) or not len(by[1]):
        net.p["mix"][:] = net.p["mix_low"][:] = 0
        net.p["out"][:] = 4.0 if len(by[1]) else (-4.0 if len(by[0]) else 0.0)
        return net
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        rows = np.concatenate([r.choice(b, batch // 2) for b in by])
        y = labels[rows].astype(np.float32)
        starts, owner = [], []
        for k, d in enumerate(rows):
            full = max(1, int((valid[first[d] : first[d + 1]] > 0).sum()) - 1)
            s = np.unique(r.integers(0, full, size=min(chunks, full)) if full > chunks else np.arange(full))
            starts.append(first[d] + s)
            owner.append(np.full(len(s), k))
        starts, owner = np.concatenate(starts), np.concatenate(owner)
        at = starts[:, None] * HALF + np.arange(2 * per)[None, :] * STRIDE
        ok = np.arange(2 * per)[None, :] < (valid[starts] + np.where(valid[starts] == per, valid[np.minimum(starts + 1, len(valid) - 1)], 0))[:, None]
        n = np.maximum(ok.sum(axis=1), 1).astype(np.float32)
        idx = np.minimum(at[:, :, None] + np.arange(WIDTH), len(buf) - 1)
        codes = buf[idx]
        x = np.concatenate([net.p["embed"][codes], met[idx][..., None].astype(np.float32)], axis=-1).reshape(len(starts) * 2 * per, -1)
        z = x @ net.p["conv"] + net.p["bias"]
        a = (np.maximum(z, 0) * ok.reshape(-1, 1)).reshape(len(starts), 2 * per, -1)
        mean = a.sum(axis=1) / n[:, None]
        cut = np.searchsorted(owner, np.arange(len(rows)))
        high, low = np.maximum.reduceat(mean, cut, axis=0), np.minimum.reduceat(mean, cut, axis=0)
        prob = 1 / (1 + np.exp(-(high @ net.p["mix"] + low @ net.p["mix_low"] + net.p["out"])))
        d_out = (prob - y) / len(y)
        g = {"mix": high.T @ d_out, "mix_low": low.T @ d_out, "out": np.array([d_out.sum()])}
        d_mean = (mean == high[owner]) * (d_out[:, None] * net.p["mix"])[owner] + (mean == low[owner]) * (d_out[:, None] * net.p["mix_low"])[owner]
        d_z = ((d_mean / n[:, None])[:, None, :] * ok[:, :, None]).reshape(z.shape) * (z > 0)
        g["conv"], g["bias"] = x.T @ d_z, d_z.sum(axis=0)
        d_x = (d_z @ net.p["conv"].T).reshape(-1, net.p["embed"].shape[1] + 1)[:, :-1]
        g["embed"] = np.stack([np.bincount(codes.ravel(), weights=d_x[:, j], minlength=257) for j in range(d_x.shape[1])], axis=1)
        g["embed"][256] = 0
        for k in net.p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
            net.p[k] = (net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, folds: int = 5, texts_per_label: int = 700, chars_per_label: int = 4_000_000) -> Network:
    """Fit on whole texts of any length: rows of each label in the order of a hash, until there are texts_per_label of
    them or they hold chars_per_label characters together (the documented bounds of the sample); only a text that
    alone has more than that is taken in pieces from all over it.  crc32(id as text) modulo folds of a row is
    not 0.  Ids are picked first, without texts."""
    own = labels.select(F.col(id_col).alias("_i"), F.col(label_col).cast("int").alias("_y")).where(F.col("_i").isNotNull() & F.col("_y").isin(0, 1) & (id_bucket("_i", folds) != 0)).distinct()
    texts = df.select(F.col(id_col).alias("_i"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    sizes = texts.groupBy("_i").agg(F.sum(F.length("_t")).alias("_c"))
    there = settle(own.join(sizes, "_i"))
    picked = []
    for y in (0, 1):
        held = 0
        for r in there.where(F.col("_y") == y).orderBy(F.xxhash64("_i"), "_i").limit(texts_per_label).collect():
            if held >= chars_per_label:
                break
            held += r["_c"]
            picked.append((r["_i"], r["_y"]))
    ids = df.sparkSession.createDataFrame(picked, own.schema)
    rows = texts.join(F.broadcast(ids), "_i").select("_i", "_y", spread(F.col("_t"), chars_per_label).alias("_t")).collect()
    rows.sort(key=lambda r: (r["_i"], r["_y"], r["_t"]))
    return train([r["_t"].encode() for r in rows], np.array([r["_y"] for r in rows], dtype=np.int64))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, folds: int = 5, threshold: float = 0.3, network: Network | None = None) -> DataFrame:
    """Score every whole text; returns id_col, held_out, score, predicted.

    Null and empty texts are scored as empty ones; without labels every score is 0.5; repeated rows
    each give a row; labels of unknown documents and other columns are not used.  Where a document
    has both labels, both count in the fit.
    """
    net = network or fit(df, labels, id_col, text_col, label_col, folds=folds)

    def predict(batches):
        for b in batches:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            scores, at = np.zeros(len(texts)), 0
            while at < len(texts):  # a few MB at a time
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) < 4 << 20):
                    size += len(texts[to])
                    to += 1
                scores[at:to] = net.score(texts[at:to])
                at = to
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    kind = dict(df.dtypes)[id_col]
    rows = df.select(id_col, text_col, (id_bucket(id_col, folds) == 0).alias("held_out"))
    return rows.mapInArrow(predict, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
