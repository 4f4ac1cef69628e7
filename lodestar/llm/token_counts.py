"""Token counts by dynamic programming that pre-tokens share along a trie.

A pre-token is a word with the mark that stands for the blank before it.  Its best segmentation into
pieces under a unigram model ends in a count.  The forward score of a prefix doesn't depend on what
follows, so the distinct pre-tokens of a block form a trie, each node of it is scored once, and the
nodes where a pre-token ends store its count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import worker_cache

MARK = "▁"
#: Distinct pre-tokens that a worker remembers before it starts over: a bound on its memory.
CACHE_WORDS = 400_000


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file and their log probabilities.

    The public file orders pieces by rank and holds no probabilities, so these follow Zipf's law over
    the ranks.  Control and byte pieces are left out; bytes are the way out for unknown characters.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / k for k in range(1, len(names) + 1)))
    return {n: -math.log(k) - total for k, n in enumerate(names, 1)}


def piece_tails(pieces: dict[str, float]) -> dict[str, float | None]:
    """All ends of pieces; the whole ones with their score.  What is no end of a piece can't become one by
    more letters before it."""
    tails: dict[str, float | None] = dict.fromkeys(p[i:] for p in pieces for i in range(1, len(p)))
    return tails | pieces


def trie_counts(words: list[str], pieces: dict[str, float], tails: dict[str, float | None] | None = None) -> list[int]:
    """Tokens of the best segmentation of each distinct word; of equal scores, the fewest tokens.

    Walks the trie of the words depth first, in their sorted order: what two neighbours share is on
    the path already, so each node is scored once and only one path is in memory.  A character that
    is no piece costs a token a byte of UTF-8, each as unlikely as the least likely piece, less 1.
    """
    fall = min(pieces.values(), default=0.0) - 1
    get, none = (piece_tails(pieces) if tails is None else tails).get, ()
    score, count, before = [0.0], [0], ""
    out = [0] * len(words)
    for k in sorted(range(len(words)), key=words.__getitem__):
        word = words[k]
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del score[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            n = len(word[end - 1].encode("utf-8", "surrogatepass"))
            best, tokens = score[end - 1] + fall * n, count[end - 1] + n
            for at in range(end - 1, -1, -1):
                p = get(word[at:end], none)
                if p is none:
                    break
                if p is not None:
                    s = score[at] + p
                    if s > best or (s == best and count[at] + 1 < tokens):
                        best, tokens = s, count[at] + 1
            score.append(best)
            count.append(tokens)
        out[k] = count[len(word)]
        before = word
    return out


def count_tokens(df: DataFrame, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text; returns id_col, n_pretokens, n_tokens.

    Null, empty and blank texts have 0 of both.  Repeated rows each give a row; other columns are not
    read.  The piece table (of a fixed size) is read on the driver and sent to the executors.
    """
    pieces = load_pieces(pieces_path)
    sent = df.sparkSession.sparkContext.broadcast((pieces, piece_tails(pieces)))

    def counted(batches):
        known: dict[str, int] = worker_cache("token_counts").setdefault(("tokens", pieces_path), {})
        for b in batches:
            texts = [(t or "").split() for t in b.column(1).to_pylist()]
            if len(known) > CACHE_WORDS:
                known.clear()
            new = list({w for t in texts for w in t}.difference(known))
            known.update(zip(new, trie_counts([MARK + w for w in new], *sent.value), strict=True))
            n = np.array([len(t) for t in texts], dtype=np.int64)
            total = np.array([sum(map(known.__getitem__, t)) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(total)], names=[id_col, "n_pretokens", "n_tokens"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(counted, f"`{id_col}` {kind}, n_pretokens bigint, n_tokens bigint")
