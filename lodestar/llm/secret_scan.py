"""Secrets in texts: three patterns, and strings near sensitive words that nothing around them explains.

A candidate is a long unbroken string shortly after a sensitive word.  Its novelty is the number of bytes by
which it lengthens the compressed text around it, zstandard being primed with a dictionary of identifiers:
words and names cost little, random keys cost about their length.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import settle, text_slices

#: In the order in which spans of one start are listed; novel are those of the method.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that make what follows sensitive.
_SENSITIVE = re.compile(r"password|passwd|passphrase|pwd|secret|token|api[_\x20-]?key|access[_\x20-]?key|private[_\x20-]?key|credential|authorization|bearer|client[_\x20-]?id|session[_\x20-]?id|signature", re.A | re.I)
_SENSITIVE_PARTS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "authorization", "bearer", "client", "session", "signature")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]{12,}")
#: Words and numbers are no candidates: letters must stand beside digits, or capitals behind small letters.
_LETTER, _DIGIT, _INNER_CAPITAL = re.compile("[A-Za-z]"), re.compile("[0-9]"), re.compile("[a-z][^a-z]*[A-Z]")
#: How far behind the sensitive word a candidate may begin, and how much text on each side it is measured in.
REACH, AROUND = 48, 128
#: Bytes of dictionary at most; words of at most 16 letters in at least two documents' candidate texts.
DICTIONARY_BYTES, DICTIONARY_WORDS = 32_768, 4_096
#: Identifiers that any code may have (fixed values).
COMMON = "access account address admin auth authorization bearer client config connection content credential database default encoding environment example export false function header host import input key local login message method module name none null number object output parameter pass password path port private public request response result return secret select server session signature source string system table test text token true type user username value version"
#: Least share of a candidate's length that it costs when compressed.
NOVEL = 0.75


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three patterns, leftmost and without overlap within a kind; places are code points."""
    out, low = [], text.lower()
    if any(n in low for n in _NAMES):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Long mixed strings that begin within reach of a sensitive word and touch no span that is found already."""
    low = text.lower()
    if not any(p in low for p in _SENSITIVE_PARTS):
        return []
    spans, out, done, at = sorted((a, b) for _, a, b in taken), [], 0, 0
    for m in _SENSITIVE.finditer(text):
        while True:
            # looked for within reach only, then taken whole; what lies in an earlier candidate is not looked at again
            c = _CANDIDATE.search(text, max(m.end(), done), m.end() + REACH + 12)
            if not c or c.start() > m.end() + REACH:
                break
            c = _CANDIDATE.match(text, c.start())
            done = c.end()
            while at < len(spans) and spans[at][1] <= c.start():
                at += 1
            if (at == len(spans) or spans[at][0] >= done) and mixed(c.group()):
                out.append((c.start(), done))
    return out


def mixed(own: str) -> bool:
    return bool(_LETTER.search(own) and _DIGIT.search(own) or _INNER_CAPITAL.search(own))


def words_of(text: str) -> set[str]:
    """Parts of names, as they are written: words of 4 to 16 letters, cut where the case changes."""
    return {w for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", text) if 4 <= len(w) <= 16}


class Novelty:
    """Marginal compressed bytes against a dictionary of identifiers."""

    def __init__(self, words: list[str]):
        data = " ".join([*reversed(words), *COMMON.split()]).encode()
        shared = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=19)
        self.press = zstandard.ZstdCompressor(dict_data=shared, write_checksum=False, write_content_size=False)

    def bytes_of(self, before: str, own: str, after: str) -> int:
        size = lambda t: len(self.press.compress(t.encode("utf-8", "surrogatepass")))
        return size(before + own + after) - size(before + after)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, base (kind, start, end), near (start, end, own, before, after): what the patterns find in every whole
    text, and candidates with the text around them."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    near = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("own", pa.string()), ("before", pa.string()), ("after", pa.string())]))

    def found(batches):
        for b in batches:
            for lo, hi in text_slices(b.column(1)):
                bases, nears = [], []
                for t in b.column(1).slice(lo, hi - lo).to_pylist():
                    t = t or ""
                    spans = base_spans(t)
                    bases.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                    nears.append([{"start": s, "end": e, "own": t[s:e], "before": t[max(0, s - AROUND) : s], "after": t[e : e + AROUND]} for s, e in candidates(t, spans)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(bases, span), pa.array(nears, near)], names=[id_col, "base", "near"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(found, f"`{id_col}` {kind}, base array<struct<kind:string,start:bigint,end:bigint>>, near array<struct<start:bigint,end:bigint,own:string,before:string,after:string>>")


def identifiers(found: DataFrame) -> list[str]:
    """The dictionary: words around candidates, from most documents first; DICTIONARY_WORDS of them at most.

    All candidates of all documents are counted; the words of a document count once."""

    def words(batches):
        for b in batches:
            out = [w for near in b.column(0).to_pylist() for w in sorted(set().union(*(words_of(f"{x['before']} {x['after']}") for x in near or ())))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["word"])

    counted = found.where(F.size("near") > 0).select("near").mapInArrow(words, "word string").groupBy("word").count().where("count > 1")
    top, size = [], 0
    for r in counted.orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS).collect():
        size += len(r["word"]) + 1
        if size > DICTIONARY_BYTES:
            break
        top.append(r["word"])
    return top


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, novel: float = NOVEL) -> DataFrame:
    """id_col, spans: array of (kind, start, end, novelty) by start, then kind in the order of KINDS; places count
    code points, the end is exclusive; novelty (bytes) is null but for the method's own spans.

    One pass over the texts; what it finds, with a few words around candidates, is written to the checkpoint
    folder, from where the dictionary is counted and candidates are measured.  Null and empty texts have no
    spans; repeated rows each give a row; of an empty table nothing is returned.  Other columns are not read.
    """
    found = settle(find(df, id_col, text_col))
    words = identifiers(found)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.int64())]))

    def measured(batches):
        held = sys.__dict__.get("_lodestar_novelty")
        if held is None or held[0] != words:
            held = sys.__dict__["_lodestar_novelty"] = (words, Novelty(words))
        for b in batches:
            rows = []
            for base, near in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                spans = [x | {"novelty": None} for x in base]
                for x in near:
                    n = held[1].bytes_of(x["before"], x["own"], x["after"])
                    if n >= novel * len(x["own"]):
                        spans.append({"kind": "novel", "start": x["start"], "end": x["end"], "novelty": n})
                rows.append(sorted(spans, key=lambda x: (x["start"], KINDS.index(x["kind"]))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, span)], names=[id_col, "spans"])

    kind = dict(df.dtypes)[id_col]
    return found.mapInArrow(measured, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,novelty:bigint>>")


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
