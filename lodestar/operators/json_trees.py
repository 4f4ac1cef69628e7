"""JSON texts as rows of leaves, level by level, in the order of the document."""

from __future__ import annotations

import json
import sys
from functools import reduce
from itertools import accumulate, chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.durable import kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: The sections of a study whose texts are read, in this order.
SECTIONS = ("extracted_jsonb", "doc", "trial", "primary_endpoints", "secondary_endpoints", "populations", "results", "protocol_changes")
PLACED = "array<struct<position:array<int>,value:string>>"
LEAF = "id {id}, keys array<string>, position array<int>, kind string, value string"


def _kind(v: Column) -> Column:
    """object, array, or what a leaf is: string, null, boolean, number."""
    name = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    return (
        F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "STRING", "string")
        .when(name == "VOID", "null").when(name == "BOOLEAN", "boolean").otherwise("number")
    )


def leaves(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """id, keys, position, kind, value: a row per leaf (and per empty object or array) of every JSON text.

    keys has the name at each level, null within an array; position has the place at each level, so its order is
    that of the document.  kind is string, number, boolean, null, or object and array for empty ones; value is
    the text of a leaf.  Null and malformed texts give no rows; a text that is a leaf itself has empty
    keys.  Each level is taken apart by built-in functions and written; there are as many rounds as levels.
    """
    start = df.select(F.col(id_col).alias("id"), F.col(json_col).alias("raw"), F.try_parse_json(json_col).alias("v")).where(F.col("v").isNotNull())
    none = lambda kind: F.expr("array()").cast(f"array<{kind}>")
    level = kept(start.select("id", none("string").alias("keys"), none("int").alias("position"), "raw", _kind(F.col("v")).alias("kind")))
    out = []
    while True:
        out.append(level)
        inner = level.where(F.col("kind").isin("object", "array")).withColumn("v", F.parse_json("raw"))
        # names come from the text in its own order, kinds from the parsed value
        named = F.from_json("raw", "map<string,string>")
        typed = F.expr("try_cast(v AS map<string,variant>)")
        listed, items = F.from_json("raw", "array<string>"), F.expr("try_cast(v AS array<variant>)")
        parts = F.when(
            F.col("kind") == "object",
            F.transform(F.map_keys("named"), lambda k, i: F.struct(k.alias("key"), i.alias("at"), F.col("named")[k].alias("raw"), _kind(F.col("typed")[k]).alias("kind"))),
        ).otherwise(F.transform("listed", lambda x, i: F.struct(F.lit(None).cast("string").alias("key"), i.alias("at"), x.alias("raw"), _kind(F.get("items", i)).alias("kind"))))
        one = inner.select("id", "keys", "position", "kind", F.when(F.col("kind") == "object", named).alias("named"), F.when(F.col("kind") == "object", typed).alias("typed"), F.when(F.col("kind") == "array", listed).alias("listed"), F.when(F.col("kind") == "array", items).alias("items"))
        below = one.select("id", "keys", "position", F.explode(parts).alias("p"))
        level = kept(below.select("id", F.concat("keys", F.array("p.key")).alias("keys"), F.concat("position", F.array("p.at")).alias("position"), F.col("p.raw").alias("raw"), F.col("p.kind").alias("kind")))
        if level.isEmpty():
            break
    bare = F.col("raw").rlike(r"^\s*(\{\s*\}|\[\s*\])\s*$")
    rows = reduce(DataFrame.unionByName, out).where(~F.col("kind").isin("object", "array") | bare)
    # a text that is a string itself still has its quotes
    whole = F.when((F.size("keys") == 0) & (F.col("kind") == "string"), F.from_json(F.concat(F.lit("["), "raw", F.lit("]")), "array<string>")[0]).otherwise(F.col("raw"))
    return rows.select("id", "keys", "position", "kind", F.when(F.col("kind") != "null", whole).alias("value"))


def section_texts(df: DataFrame, id_col: str, json_col: str, sections: tuple[str, ...] = SECTIONS) -> DataFrame:
    """id, text: the strings within objects of the sections, in the order of the sections and then of the document, with
    blanks between them; a document's tree is walked at once, not level by level.  Strings that are a section themselves or stand in its list are not read, nor
    those in lists of lists; documents without any string have no row."""

    @F.arrow_udf(PLACED)
    def strings(body: pa.Array) -> pa.Array:
        decoder = json.JSONDecoder(parse_int=lambda x: None, parse_float=lambda x: None)  # Python bounds the length of numbers
        found = [sorted(section_strings(decoder, text, sections)) for text in body.to_pylist()]
        flat = list(chain.from_iterable(found))
        offsets = lambda lists: pa.array(list(accumulate(map(len, lists), initial=0)), pa.int32())
        at = [p for p, _ in flat]
        positions = pa.ListArray.from_arrays(offsets(at), pa.array(list(chain.from_iterable(at)), pa.int32()))
        return pa.ListArray.from_arrays(offsets(found), pa.StructArray.from_arrays([positions, pa.array([v for _, v in flat], pa.string())], names=["position", "value"]))

    # what Spark cannot parse has no strings
    whole = df.select(F.col(id_col).alias("id"), F.col(json_col).alias("raw")).where(F.try_parse_json("raw").isNotNull())
    placed = whole.select("id", strings("raw").alias("p")).where(F.size("p") > 0)
    by = placed.groupBy("id").agg(F.collect_list("p").alias("c"))  # the strings of one document; each row's are in order
    return by.select("id", F.when(F.size("c") == 1, F.get("c", F.lit(0))).otherwise(F.array_sort(F.flatten("c"))).alias("parts")).select("id", F.array_join(F.transform("parts", lambda p: p["value"]), " ").alias("text"))


def section_strings(decoder: json.JSONDecoder, text: str, sections: tuple[str, ...]) -> list[tuple[list[int], str]]:
    """Place (rank of the section, then the place at each level) and value of the strings of one JSON text that
    `section_texts` reads; of text after the value as little is read as by Spark."""
    tree, _ = decoder.raw_decode(text.lstrip(" \t\r\n"))
    found: list[tuple[list[int], str]] = []
    todo = [([sections.index(k) + 1, i], v, False) for i, (k, v) in enumerate(tree.items()) if k in sections and isinstance(v, dict | list)] if isinstance(tree, dict) else []
    while todo:
        at, node, within = todo.pop()
        listed = isinstance(node, list)
        if listed and within:  # a list of lists
            continue
        for i, v in enumerate(node if listed else node.values()):
            if type(v) is str and not (listed and len(at) == 2):
                found.append(([*at, i], v.encode("utf-8", "replace").decode()))
            elif isinstance(v, dict | list):
                todo.append(([*at, i], v, listed))
    return found


def canonical(v: Column) -> Column:
    """A variant as text that is the same for equal values, whatever the order of keys."""
    return F.to_json(v)


def shown(v: Column) -> Column:
    """A variant's text: strings without quotes, all else as JSON."""
    return F.when(_kind(v) == "string", F.try_variant_get(v, "$", "string")).when(_kind(v) == "null", F.lit(None)).otherwise(canonical(v))
