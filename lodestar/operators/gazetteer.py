"""Names of a dictionary in texts, with their places; occurrences may overlap."""

from __future__ import annotations

import sys

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.durable import kept

#: What runs on executors is sent whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: Bytes of names that one automaton holds; larger dictionaries are looked up block by block.
MOST_BYTES = 16 << 20
#: Rows that a task holds before it hands them on.
ROWS = 50_000


def lower(text: str) -> str:
    """Lower case of the same length: letters whose lower case is longer stay, so places hold in both."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def find_names(texts: DataFrame, names: DataFrame, id_col: str, text_col: str, *, most_bytes: int = MOST_BYTES) -> DataFrame:
    """id_col, name, name_type, start, end (code points, end exclusive), found (as written): every occurrence of every
    name in the lower-cased texts, also within and across other names.

    names(name, name_type) are in lower case already; null and empty ones find nothing, a name that stands there
    twice has its first type.  One automaton finds all names in a single pass over a text.  Its size is bounded: the
    dictionary's bytes are summed first and dealt by hash into as many blocks as they ask for, each with a pass
    of its own over the texts.  No shuffle of texts in any case; null texts have no names.
    """
    own = kept(names.where(F.col("name") != "").groupBy("name").agg(F.min("name_type").alias("name_type")))
    blocks = 1 + (own.agg(F.sum(F.octet_length("name"))).first()[0] or 0) // most_bytes
    out = None
    for b in range(blocks):
        held = [(r["name"], r["name_type"]) for r in own.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == b).collect()]
        part = _find(texts, held, id_col, text_col, names.schema["name_type"].dataType.simpleString())
        out = part if out is None else out.unionByName(part)
    return out


def _find(texts: DataFrame, names: list[tuple], id_col: str, text_col: str, kind: str) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(names)
    id_type = dict(texts.dtypes)[id_col]
    columns = [id_col, "name", "name_type", "start", "end", "found"]

    def find(batches):
        automaton = ahocorasick.Automaton()
        for k, (name, _) in enumerate(sent.value):
            automaton.add_word(name, k)
        if sent.value:
            automaton.make_automaton()
        rows: list[tuple] = []

        def batch():
            arrays = [pa.array(c) for c in zip(*rows, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=columns)

        for b in batches if sent.value else ():
            for key, text in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                key = key.as_py()
                for last, k in automaton.iter(lower(text)):
                    name, name_type = sent.value[k]
                    start = last + 1 - len(name)
                    rows.append((key, name, name_type, start, last + 1, text[start : last + 1]))
                    if len(rows) == ROWS:
                        yield batch()
        if rows:
            yield batch()

    return texts.select(F.col(id_col), F.col(text_col)).mapInArrow(find, f"`{id_col}` {id_type}, name string, name_type {kind}, start bigint, end bigint, found string")
