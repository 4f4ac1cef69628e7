"""A training corpus from documents: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import langid, mixing, near_dups, packing, unit_dedup
from lodestar.llm.common import read, settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: By how much, as a share, the second language must cost more.
LEAST_SCORE = 0.01


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null, empty and letterless texts, and those that two languages
    explain equally well (score under LEAST_SCORE).  Where a label is missing, the prediction is the label."""
    found = langid.identify(docs, carry=COLUMNS).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest id stays; shingles are of five words."""
    gone = near_dups.classes(docs, shingle=5).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go, and documents of which nothing but white space is left."""
    out = unit_dedup.deduplicate(docs, carry=("lang", "source"))
    left = (F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\f\r")) != "")
    return out.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to twice, so that the mixture is flatter; every document stays."""
    return mixing.mix(docs, max_repeat=2.0, carry=COLUMNS).select(*COLUMNS)


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1,024 tokens, a row per piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("source_mixing", source_mixing), ("window_packing", window_packing)]
#: No stage but the filters is expressible in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the checkpoint folder before the next; a row per
    packed piece.  Rows with a null id are in no class of near-duplicates and stay; rows that share an
    id are filtered alike; an empty table gives no rows; columns besides COLUMNS are left behind."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
