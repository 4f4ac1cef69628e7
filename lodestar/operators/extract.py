"""Codes, registry ids, names and wording in documents, and links between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import count_matches
from lodestar.functions.udfs import regex_spans

# Shapes of asset codes, and of registry ids.
CODE_PATTERNS = (
    r"\b[A-Z]{1,4}-\d{2,5}\b",
    r"\b[A-Z]{1,4}\d{2,5}\b",
    r"\b[A-Z]{2,5}-[A-Z]{1,3}-\d{2,5}\b",
    r"\b[A-Z]{1,4}-\d+[A-Z]{1,2}\b",
    r"\b[A-Z]{1,4}\d+[A-Z]{1,2}\b",
)
REGISTRY_PATTERN = r"(?i)\bNCT\d+\b"
# Cautious and definite wording.
CAUTIOUS = (
    r"\b(may|might|could|possibly|potentially|suggests?|indicates?|appears?|seems?)\b",
    r"\b(preliminary|initial|exploratory|hypothesis|hypothesized)\b",
    r"\b(limited|restricted|constrained|cautious|careful)\b",
    r"\b(need\s+to\s+confirm|requires?\s+validation|further\s+study)\b",
    r"\b(not\s+conclusive|inconclusive|uncertain|unclear)\b",
)
DEFINITE = (
    r"\b(clearly|definitively|conclusively|unequivocally|demonstrates?|proves?|establishes?)\b",
    r"\b(significant|highly\s+significant|statistically\s+significant)\b",
    r"\b(robust|strong|compelling|convincing|definitive)\b",
    r"\b(confirm|validate|verify|demonstrate|establish)\b",
    r"\b(clear|obvious|evident|apparent|definite)\b",
)
# Confidence by kind of link.
LINK_CONFIDENCE = {"nct_near_asset": 1.0, "exact_intervention_match": 0.95, "company_pr_bias": 0.90, "abstract_specificity": 0.85}
NEAR = 250
#: Rows of a dictionary that is sent to all tasks, at most.
BROADCAST = 100_000


def entities(docs: DataFrame, doc: str, text: str, pattern: str | tuple[str, ...], kind: str, page: str | None = None) -> DataFrame:
    """Matches of a pattern, or of several on their own, with their places: doc, page_no, ent_type, value_text, value_norm, char_start, char_end."""
    spans = regex_spans(*((pattern,) if isinstance(pattern, str) else pattern))
    rows = docs.select(F.col(doc).alias("doc_id"), (F.col(page) if page else F.lit(1)).alias("page_no"), F.explode(spans(F.col(text))).alias("m"))
    return rows.select("doc_id", "page_no", F.lit(kind).alias("ent_type"), F.col("m.value").alias("value_text"), F.upper("m.value").alias("value_norm"), F.col("m.start").alias("char_start"), F.col("m.end").alias("char_end"))


def codes(docs: DataFrame, doc: str, text: str, page: str | None = None) -> DataFrame:
    """Asset codes of all shapes, each shape looked for on its own (so they may overlap); a row per place and text."""
    return entities(docs, doc, text, CODE_PATTERNS, "code", page).distinct()


def registry_ids(docs: DataFrame, doc: str, text: str, page: str | None = None) -> DataFrame:
    """Trial registry ids, upper-cased."""
    return entities(docs, doc, text, REGISTRY_PATTERN, "nct", page)


def code_variants(found: DataFrame) -> DataFrame:
    """Each code as written and without hyphens, at the same place."""
    both = F.array_distinct(F.array(F.col("value_norm"), F.regexp_replace("value_norm", "-", "")))
    return found.withColumn("value_norm", F.explode(both))


def dedupe(found: DataFrame, strategy: str = "strict") -> DataFrame:
    """One row per span and text (strict), per span (position), or per document and text (content); the
    most confident first, then the earliest."""
    keys = {"strict": ["doc_id", "page_no", "char_start", "char_end", "value_norm"], "position": ["doc_id", "page_no", "char_start", "char_end"], "content": ["doc_id", "value_norm"]}[strategy]
    rest = [c for c in ("page_no", "char_start", "char_end", "value_norm") if c not in keys]
    confidence = F.col("confidence").desc() if "confidence" in found.columns else F.lit(1)
    w = Window.partitionBy(*keys).orderBy(confidence, *rest)
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def near_pairs(left: DataFrame, right: DataFrame, reach: int = NEAR, midpoints: bool = True) -> DataFrame:
    """Pairs on one page whose midpoints (or starts) are at most `reach` apart.

    Places are cut into stretches of that length and a left row meets the stretch it's in and both
    beside it, so the join is on equal keys and a page's pairs far apart never meet.
    """
    at = lambda p: (F.col(f"{p}char_start") + F.col(f"{p}char_end")) / 2 if midpoints else F.col(f"{p}char_start").cast("double")
    a = left.select("doc_id", "page_no", F.col("value_norm").alias("left_value"), F.col("char_start").alias("left_start"), at("").alias("l"))
    b = right.select("doc_id", "page_no", F.col("value_norm").alias("right_value"), F.col("char_start").alias("right_start"), at("").alias("r"), F.floor(at("") / reach).alias("cell"))
    wide = a.withColumn("cell", F.explode(F.sequence(F.floor(F.col("l") / reach) - 1, F.floor(F.col("l") / reach) + 1)))
    met = wide.join(b, ["doc_id", "page_no", "cell"]).withColumn("distance", F.abs(F.col("l") - F.col("r")))
    return met.where(F.col("distance") <= reach).select("doc_id", "page_no", "left_value", "left_start", "right_value", "right_start", "distance")


def link_by_alias(pairs: DataFrame, alias_table: DataFrame, heuristic: str = "HP-1", confidence: float = 1.0) -> DataFrame:
    """Pairs (right value is a code) to assets that have the code as alias; a row per asset."""
    return pairs.join(alias_table.select("asset_id", F.col("alias_norm").alias("right_value")), "right_value").select("doc_id", F.col("left_value").alias("nct_id"), "asset_id", F.lit(heuristic).alias("heuristic"), F.lit(confidence).alias("confidence")).distinct()


def unique_codes(found: DataFrame, alias_table: DataFrame) -> DataFrame:
    """Codes in a document that stand for exactly one asset."""
    one = alias_table.groupBy("alias_norm").agg(F.min("asset_id").alias("asset_id"), F.max("asset_id").alias("hi")).where("asset_id = hi").select(F.col("alias_norm").alias("value_norm"), "asset_id")
    return found.select("doc_id", "value_norm").distinct().join(one, "value_norm")


def downgrade_conflicts(links: DataFrame, combination: DataFrame, by: float = 0.20) -> DataFrame:
    """Less confidence for documents that name several assets, unless their wording is of a combination.

    combination(doc_id, is_combination).  Assets are counted per document and joined back.
    """
    n = links.groupBy("doc_id").agg(F.countDistinct("asset_id").alias("assets"))
    out = links.join(n, "doc_id").join(combination, "doc_id", "left")
    conflict = (F.col("assets") > 1) & ~F.coalesce("is_combination", F.lit(False))
    return out.withColumn("confidence", F.when(conflict, F.greatest(F.lit(0.0), F.round(F.col("confidence") - by, 6))).otherwise(F.col("confidence"))).withColumn("conflict", conflict).drop("is_combination")


def link_precision(audit: DataFrame, by: str = "heuristic") -> DataFrame:
    """Reviewed links, correct ones and precision to four places per heuristic; null without reviews."""
    reviewed, right = F.count("label"), F.count_if("label")
    return audit.groupBy(by).agg(F.count("*").alias("links"), reviewed.alias("reviewed"), right.alias("correct"), F.round(F.try_divide(right, reviewed), 4).alias("precision"))


def may_promote(precision: DataFrame, least_precision: float = 0.95, least: int = 50, count_all: bool = False) -> DataFrame:
    """Heuristics precise enough on enough labels (or, if count_all, on enough links)."""
    n = F.col("links") if count_all else F.col("reviewed")
    return precision.withColumn("promote", F.coalesce((F.col("precision") >= least_precision) & (n >= least), F.lit(False)))


def chunks(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Paragraphs with their offset: doc, para_no (from 0), start, chunk."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n\n")
    starts = F.aggregate(parts, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p) + 2)))
    rows = docs.select(F.col(doc).alias("doc_id"), F.posexplode(F.arrays_zip(parts.alias("chunk"), F.slice(starts, 1, F.size(parts)).alias("start"))).alias("para_no", "p"))
    return rows.select("doc_id", "para_no", F.col("p.start").alias("start"), F.col("p.chunk").alias("chunk")).where(F.trim("chunk") != "")


def tone(text: Column) -> Column:
    """Struct (cautious, definite, tone): one side needs more than twice the other."""
    a, b = count_matches(text, CAUTIOUS), count_matches(text, DEFINITE)
    return F.struct(a.alias("cautious"), b.alias("definite"), F.when(b > 2 * a, "definitive").when(a > 2 * b, "cautious").otherwise("neutral").alias("tone"))


def citations(text: Column) -> Column:
    """Struct (doi, pmid), empty strings as null."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.struct(some(F.regexp_extract(text, r"\b(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)", 1)).alias("doi"), some(F.regexp_extract(text, r"(?i)PMID:?\s*(\d+)", 1)).alias("pmid"))


def dictionary_hits(docs: DataFrame, doc: str, text: str, names: DataFrame) -> DataFrame:
    """Single words and pairs of words with a blank between (a word is in one pair at most) of a text that a dictionary
    (alias_norm, asset_id) holds; equi-joined.  Spark takes what is exploded for as small as the texts' files, so it is never
    what is broadcast: a dictionary of at most BROADCAST rows is, with a larger one both sides are sorted and merged."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(F.lower(t), F.lit(r"([a-z][a-z0-9\-]{2,})"), 1)
    two = F.transform(F.regexp_extract_all(t, F.lit(r"(\b[A-Za-z][A-Za-z0-9\-]+ [A-Za-z][A-Za-z0-9\-]+\b)"), 1), F.lower)
    base = docs.select(F.col(doc).alias("doc_id"), words.alias("w"), two.alias("p"))
    grams = base.select("doc_id", F.explode(F.array_distinct(F.concat("w", "p"))).alias("alias_norm"))
    small = names.limit(BROADCAST + 1).count() <= BROADCAST
    return grams.join(names.hint("broadcast" if small else "merge"), "alias_norm").select("doc_id", "alias_norm", "asset_id")
