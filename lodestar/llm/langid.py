"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds a bounded sample of labelled text.  A text is cut,
word by word, into the longest matches that the automaton knows; a language that needs p phrases
for n characters costs p * log2(sample length) / n bits a character, and the cheapest language wins.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import WHITE, id_bucket, is_small, settle, spread, text_slices, worker_cache

LETTER = re.compile(r"[^\W\d_]")
#: Texts are runs of letters: signs and digits tell of junk, not of a language.
WORD = re.compile(r"[^\W\d_]+")
#: Bytes that a worker's words may take before it starts over, and those of a word besides its letters.
CACHE_BYTES, WORD_BYTES = 40 << 20, 250


class SuffixAutomaton:
    """All substrings of a text; state 0 is the empty one."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for ch in text:
            cur = len(length)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and ch not in self.next[p]:
                self.next[p][ch] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][ch]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(length)
                    self.next.append(dict(self.next[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and self.next[p].get(ch) == q:
                        self.next[p][ch] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def phrases(self, word: str) -> int:
        """Longest matches that cover the word from left to right; a character unknown alone counts as one."""
        n, at, end, step = 0, 0, len(word), self.next
        while at < end:
            state, j = step[0], at
            while j < end and (to := state.get(word[j])) is not None:
                state = step[to]
                j += 1
            n += 1
            at = j if j > at else at + 1
        return n


class Parser:
    """Automata of all languages, and the phrase counts of words met before."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        self.automata = [SuffixAutomaton(samples[k]) for k in self.langs]
        self.bits = np.array([math.log2(max(2, len(samples[k]))) for k in self.langs])
        self.rows: dict[str, int] = {}
        self.counts: list[list[int]] = []
        self.held = 0

    def costs(self, texts: list[str]) -> np.ndarray:
        """Bits a character for each text and language; texts without words cost 0."""
        if self.held > CACHE_BYTES:
            self.rows, self.counts, self.held = {}, [], 0
        found, ends, chars, rows, counts = [], [], [], self.rows, self.counts
        for text in texts:
            words = WORD.findall(text.lower())
            for w in words:
                if (k := rows.get(w)) is None:
                    k = rows[w] = len(counts)
                    counts.append([a.phrases(f" {w} ") for a in self.automata])
                    self.held += len(w) + WORD_BYTES
                found.append(k)
            ends.append(len(found))
            chars.append(max(1, sum(map(len, words)) + len(words)))
        table = np.asarray(counts, dtype=np.int64).reshape(-1, len(self.langs))
        total = np.zeros((len(found) + 1, len(self.langs)), dtype=np.int64)
        np.cumsum(table[np.asarray(found, dtype=np.int64)], axis=0, out=total[1:])
        ends = np.asarray(ends, dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return (total[ends] - total[starts]) * self.bits / np.asarray(chars)[:, None]


def sample_texts(df: DataFrame, id_col: str, text_col: str, lang_col: str, train, docs_per_lang: int, chars_per_doc: int) -> dict[str, str]:
    """A bounded sample of labelled text per language: the documents with the smallest hashes, of any length; of those that
    are longer than chars_per_doc, four pieces from all over the text, evenly apart, that hold so many together.  Every
    language with a text has a sample.  Ids are ranked first, without texts, and of a language only so
    many as a count says are needed, so no task ranks a language."""
    if docs_per_lang < 1 or chars_per_doc < 4:
        raise ValueError("the sample needs a document and four characters at least")
    own = df.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_l")).where(train & F.col("_l").isNotNull())
    own = own.where(F.btrim("_t", F.lit(WHITE)) != "")
    ids = settle(own.select("_i", "_l", F.xxhash64("_i").alias("_h")))
    counts = ids.groupBy("_l").count()
    few = ids.join(F.broadcast(counts) if is_small(counts, 10_000) else counts, "_l").where(F.pmod("_h", F.greatest(F.lit(1), F.expr(f"`count` div {8 * docs_per_lang}"))) == 0)
    picked = few.distinct().withColumn("_n", F.row_number().over(Window.partitionBy("_l").orderBy("_h", "_i"))).where(F.col("_n") <= docs_per_lang)
    own = own.withColumn("_t", spread(F.col("_t"), chars_per_doc, 4))
    rows = own.join(F.broadcast(picked.select("_i", "_l")), ["_i", "_l"]).select("_l", "_i", "_t").distinct().collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["_l"], r["_i"], r["_t"])):
        out.setdefault(r["_l"], []).append(" ".join(WORD.findall(r["_t"].lower())))
    return {k: " " + " ".join(v) + " " for k, v in out.items()}


def clean_samples(samples: dict[str, str], words: int = 12) -> dict[str, str]:
    """Drop stretches of a language's sample that another language's sample explains better.

    Labelled documents quote other languages; each stretch of so many words is parsed by the
    automata of the others and by one of its own language that doesn't hold it (the other half).
    """
    halves = {}
    for k, v in samples.items():
        w = v.split()
        pieces = [" ".join(w[i : i + words]) for i in range(0, len(w), words)]
        halves[k] = (pieces[::2], pieces[1::2])
    kept: dict[str, list[str]] = {k: [] for k in samples}
    for side in (0, 1):
        parser = Parser({k: " " + " ".join(h[1 - side]) + " " for k, h in halves.items()})
        for k, h in halves.items():
            if h[side]:
                best = parser.costs(h[side]).argmin(axis=1)
                kept[k] += [p for p, b in zip(h[side], best, strict=True) if parser.langs[b] == k]
    return {k: " " + " ".join(kept[k] or [samples[k]]) + " " for k in samples}


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, folds: int = 5, docs_per_lang: int = 48, chars_per_doc: int = 800, carry: tuple[str, ...] = ()) -> DataFrame:
    """Predict the language of every whole text.

    Learns from rows whose crc32(id as text) modulo folds is not 0 and whose label is not null: at
    most docs_per_lang documents of each language, of any length, and of each its whole text or chars_per_doc
    characters from all over it (a bounded sample, so the automata have a fixed size).  Returns id_col, held_out, lang_pred, score
    and the columns named in carry.

    Null, empty and letterless texts are `und` with score 0, and so is everything where no labelled
    text exists.  Ties go to the language that sorts first; repeated rows each give a row; other
    columns are not read.  score is 1 - cheapest / second cheapest cost (1 with one language).
    """
    samples = sample_texts(df, id_col, text_col, lang_col, id_bucket("_i", folds) != 0, docs_per_lang, chars_per_doc)
    samples = clean_samples({k: v for k, v in samples.items() if v.strip()})
    keep = [c for c in carry if c != id_col]
    if clash := {"held_out", "lang_pred", "score"}.intersection(keep):
        raise ValueError(f"columns named like an output: {sorted(clash)}")
    key = ("langid", hash(tuple(sorted(samples.items()))))

    def predict(batches):
        cache = worker_cache("langid")
        if samples and key not in cache:
            cache[key] = Parser(samples)
        for whole in batches:
            for lo, hi in text_slices(whole.column(1)):
                b = whole.slice(lo, hi - lo)
                texts = [t or "" for t in b.column(1).to_pylist()]
                names, scores = ["und"] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if LETTER.search(t)] if samples else []
                if known:
                    parser = cache[key]
                    costs = parser.costs([texts[i] for i in known])
                    best = costs.argmin(axis=1)
                    low = np.partition(costs, 1, axis=1)[:, :2] if costs.shape[1] > 1 else np.stack([np.zeros(len(known)), np.ones(len(known))], axis=1)
                    scores[known] = np.clip(1 - low[:, 0] / np.maximum(low[:, 1], 1e-12), 0, 1)
                    for i, k in zip(known, best, strict=True):
                        names[i] = parser.langs[k]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64()), *(b.column(3 + i) for i in range(len(keep)))], names=[id_col, "held_out", "lang_pred", "score", *keep])

    types = dict(df.dtypes)
    rows = df.select(id_col, F.col(text_col).alias("_t"), (id_bucket(id_col, folds) == 0).alias("held_out"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)))
    return rows.mapInArrow(predict, f"`{id_col}` {types[id_col]}, held_out boolean, lang_pred string, score double" + "".join(f", `{c}` {types[c]}" for c in keep))
