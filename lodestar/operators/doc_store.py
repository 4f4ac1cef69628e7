"""Fetched pages as documents, text pages, tables, entities, citations and links; keyed by what a page holds."""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import extract, gazetteer
from lodestar.operators.durable import kept
from lodestar.sources import html as pages

for _module in (sys.modules[__name__], pages):  # what runs on executors is sent whole
    cloudpickle.register_pickle_by_value(_module)

TABLES = ("documents", "pages", "tables", "entities", "citations", "links")
PARSED = T.StructType([T.StructField("text", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType()))])
#: Confidence by kind of link; others count in full.
CONFIDENCE = {"nct_near_asset": 1.0, "code_in_text": 0.90, "inn_in_text": 0.85, "exact_intervention_match": 0.95}


@F.pandas_udf(PARSED)
def parsed(content: pd.Series) -> pd.DataFrame:
    """Visible text in one line, and each table as JSON rows."""
    out = []
    for c in content:
        grids = pages.table_grids(c or "")
        out.append((" ".join(pages.visible_text(c or "").split()), [json.dumps(g, ensure_ascii=False, separators=(",", ":")) for g in grids]))
    return pd.DataFrame(out, columns=["text", "tables"])


def parse(fetched: DataFrame, names: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six tables of fetched(url, content, content_type, source_type, publisher, published_at, fetched_at).

    A document's id is the SHA-256 of its content, so equal contents are one document, that of the earliest fetch (then
    the smallest url); null contents are none.  HTML is read as one page; of other types only the row and an
    empty page are kept.  entities: codes, registry ids and, with names(name, name_type), dictionary names; links:
    `nct_near_asset` for each code or name at most 250 characters from a registry id, and `<type>_in_text` for
    each code or name.  Texts are parsed once and written.
    """
    digest = F.sha2("content", 256)
    earliest = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("fetched_at"), "url"))
    own = fetched.where("content IS NOT NULL").withColumn("doc_id", digest)
    # copies are dropped before their contents move: only ids and keys are ranked
    first = own.select("doc_id", "url", "fetched_at").withColumn("_n", earliest).where("_n = 1").select("doc_id", "url", F.col("fetched_at").alias("_at"))
    one = own.join(first, ["doc_id", "url"], "left_semi").dropDuplicates(["doc_id"])
    is_html = F.coalesce(F.col("content_type"), F.lit("text/html")).contains("text/html")
    read = kept(one.withColumn("_p", F.when(is_html, parsed("content"))).select("doc_id", "url", "content_type", "source_type", "publisher", "published_at", "fetched_at", F.coalesce("_p.text", F.lit("")).alias("text"), F.coalesce("_p.tables", F.array().cast("array<string>")).alias("grids"), is_html.alias("_html")))
    texts = read.where("_html").select("doc_id", "text", F.lit(1).alias("page_no"))
    mark = lambda df, detector: df.withColumn("detector", F.lit(detector))
    found = mark(extract.codes(texts, "doc_id", "text").unionByName(extract.registry_ids(texts, "doc_id", "text")), "regex")
    if names is not None:
        spans = gazetteer.find_names(texts, names, "doc_id", "text")
        found = found.unionByName(mark(spans.select("doc_id", F.lit(1).alias("page_no"), F.col("name_type").alias("ent_type"), F.col("found").alias("value_text"), F.col("name").alias("value_norm"), F.col("start").cast("int").alias("char_start"), F.col("end").cast("int").alias("char_end")), "dict"))
    found = kept(found)
    cited = texts.select("doc_id", extract.citations(F.col("text")).alias("c")).select("doc_id", "c.doi", "c.pmid").where("doi IS NOT NULL OR pmid IS NOT NULL")
    return {
        "documents": read.select("doc_id", "source_type", F.col("url").alias("source_url"), "publisher", "published_at", "content_type", F.lit("linked").alias("status"), "fetched_at"),
        "pages": read.select("doc_id", F.lit(1).alias("page_no"), F.length("text").alias("char_count"), "text"),
        "tables": read.select("doc_id", F.lit(1).alias("page_no"), F.posexplode("grids").alias("table_idx", "table_jsonb")),
        "entities": found,
        "citations": cited,
        "links": links(found),
    }


def links(entities: DataFrame) -> DataFrame:
    """doc_id, nct_id, asset, link_type, confidence: what lies near a registry id, and every asset in a text once for
    each place it stands at."""
    assets = entities.where("ent_type IN ('code', 'inn', 'generic')")
    near = extract.near_pairs(assets, entities.where("ent_type = 'nct'"))
    score = lambda kind: F.coalesce(*(F.when(kind == k, F.lit(v)) for k, v in CONFIDENCE.items()), F.lit(1.0))
    a = near.select("doc_id", F.col("right_value").alias("nct_id"), F.col("left_value").alias("asset"), F.lit("nct_near_asset").alias("link_type"))
    b = assets.select("doc_id", F.lit(None).cast("string").alias("nct_id"), F.col("value_norm").alias("asset"), F.concat("ent_type", F.lit("_in_text")).alias("link_type"))
    return a.unionByName(b).withColumn("confidence", score(F.col("link_type")))
