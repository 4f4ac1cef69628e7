"""Trial versions: differences, materiality, change scores and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.stats import let
from lodestar.operators.json_trees import canonical, shown

# Fields whose change always matters, and weights by severity.
HIGH_IMPACT = ("primary_endpoint_text", "sample_size", "analysis_plan", "arms", "primary_result", "subgroups", "inclusion_criteria", "exclusion_criteria")
SEVERE = ("primary_endpoint_text", "sample_size", "analysis_plan")
SEVERITY_WEIGHT = {"H": 1.0, "M": 0.6, "L": 0.3}
NUMERIC_CHANGE, SIZE_CHANGE, TEXT_SIMILARITY = 0.3, 0.2, 0.7


def with_previous(versions: DataFrame, trial: str, order: list[str], fields: list[str]) -> DataFrame:
    """Each version beside the one before it (was_*); the first of a trial has none (n = 1)."""
    w = Window.partitionBy(trial).orderBy(*order)
    return versions.select("*", F.row_number().over(w).alias("n"), *(F.lag(f).over(w).alias(f"was_{f}") for f in fields))


def last_two(versions: DataFrame, trial: str, order: list[str]) -> DataFrame:
    """The last two versions of each trial; ranked before the shuffle."""
    w = Window.partitionBy(trial).orderBy(*(F.col(c).desc() for c in order))
    return versions.withColumn("recency", F.row_number().over(w)).where("recency <= 2")


def relative_change(old: Column, new: Column) -> Column:
    """Absolute change over the old size; null where the old is 0 or either is null."""
    return F.try_divide(F.abs(new - old).cast("double"), F.abs(old))


def is_material(field: str, old: Column, new: Column, kind: str = "text", similarity: Column | None = None) -> Column:
    """High-impact fields always; numbers beyond 30 %; texts under the similarity limit."""
    if field in HIGH_IMPACT:
        return F.lit(True)
    if kind == "number":
        return F.coalesce(relative_change(old, new) > NUMERIC_CHANGE, F.lit(False))
    return F.coalesce(similarity < TEXT_SIMILARITY, F.lit(False)) if similarity is not None else F.lit(False)


def severity(field: str, material: Column) -> Column:
    return F.when(material, "H" if field in SEVERE else "M").otherwise("L")


def change(field: str, old: Column, new: Column, kind: str = "text", similarity: Column | None = None) -> Column:
    """Struct (path, type, old, new, material, severity) where the two differ, else null."""
    material = is_material(field, old, new, kind, similarity)
    how = F.when(old.isNull(), "added").when(new.isNull(), "removed").otherwise("modified")
    return F.when(~old.eqNullSafe(new), F.struct(F.lit(field).alias("path"), how.alias("type"), old.cast("string").alias("old"), new.cast("string").alias("new"), material.alias("material"), severity(field, material).alias("severity")))


def change_score(changes: Column, weights: dict[str, float] | None = None) -> Column:
    """Severities weighted by field, over the weights' sum or 1."""
    weight = lambda c: F.coalesce(*(F.when(c["path"].contains(k), F.lit(v)) for k, v in (weights or {}).items()), F.lit(1.0))
    sev = lambda c: F.coalesce(*(F.when(c["severity"] == k, F.lit(v)) for k, v in SEVERITY_WEIGHT.items()), F.lit(0.5))
    sums = F.aggregate(changes, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w")), lambda a, c: F.struct((a["s"] + weight(c) * sev(c)).alias("s"), (a["w"] + weight(c)).alias("w")))
    return F.when(F.size(changes) == 0, 0.0).otherwise(sums["s"] / F.greatest(sums["w"], F.lit(1.0)))


def json_diff(old: Column, new: Column) -> Column:
    """Differences of two JSON objects by top-level key: array of (key, type, old, new), keys sorted.

    Values are compared in whole: objects whatever the order of their keys, lists in order, and the text "5" is not
    the number 5.  A text that is no object counts as an empty one.
    """
    to_map = lambda c: F.coalesce(F.try_parse_json(c).try_cast("map<string,variant>"), F.create_map().cast("map<string,variant>"))

    def of(m: Column) -> Column:
        a, b = m["a"], m["b"]
        keys = F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b)))
        item = lambda k: F.struct(k.alias("key"), F.when(~F.map_contains_key(a, k), "added").when(~F.map_contains_key(b, k), "removed").otherwise("modified").alias("type"), shown(a[k]).alias("old"), shown(b[k]).alias("new"))
        same = lambda k: F.map_contains_key(a, k) & F.map_contains_key(b, k) & canonical(a[k]).eqNullSafe(canonical(b[k]))
        return F.transform(F.filter(keys, lambda k: ~same(k)), item)

    # both texts are parsed once, not at every mention of a key
    return let(F.struct(to_map(old).alias("a"), to_map(new).alias("b")), of)


CRITICAL_PLAN = ("alpha", "one_sided", "planned_interims")


def plan_change(old: Column, new: Column) -> Column:
    """Struct (material, severity, critical) of two analysis plans (JSON objects) that differ, else null; material where
    a critical field that both have differs."""
    def of(x: Column) -> Column:
        critical = F.transform(F.filter(x["diff"], lambda d: d["key"].isin(*CRITICAL_PLAN) & (d["type"] == "modified")), lambda d: d["key"])
        made = lambda c: F.struct((F.size(c) > 0).alias("material"), F.when(F.size(c) > 0, "H").otherwise("M").alias("severity"), c.alias("critical"))
        return F.when((F.size(x["diff"]) > 0) & _is_object(x["old"]) & _is_object(x["new"]), let(critical, made))

    return let(_texts_and_diff(old, new), of)


def arms_change(old: Column, new: Column) -> Column:
    """Struct (material, severity, arm_count_change) of two sets of arms (JSON objects) that differ, else null; material
    where their numbers differ."""
    count = lambda c: F.size(F.json_object_keys(c))
    made = lambda more: F.struct((more != 0).alias("material"), F.when(more != 0, "H").otherwise("M").alias("severity"), more.alias("arm_count_change"))
    return let(_texts_and_diff(old, new), lambda x: F.when((F.size(x["diff"]) > 0) & _is_object(x["old"]) & _is_object(x["new"]), let(count(x["new"]) - count(x["old"]), made)))


def _texts_and_diff(old: Column, new: Column) -> Column:
    return let(F.struct(old.alias("old"), new.alias("new")), lambda x: F.struct(x["old"].alias("old"), x["new"].alias("new"), json_diff(x["old"], x["new"]).alias("diff")))


def _is_object(c: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))


def array_changes(old: Column, new: Column) -> Column:
    """(added, removed) members."""
    none = F.array().cast("array<string>")
    a, b = F.coalesce(old, none), F.coalesce(new, none)
    return F.struct(F.array_except(b, a).alias("added"), F.array_except(a, b).alias("removed"))


def summary(versions: DataFrame, trial: str, captured: str, material: Column, since: Column | None = None) -> DataFrame:
    """Per trial: versions, changes a year, material changes and the risk they stand for.

    `material` counts material changes of a row against the row before.  `since` bounds the look-back.
    """
    rows = versions if since is None else versions.where(F.col(captured) >= since)
    out = rows.groupBy(trial).agg(F.count("*").alias("versions"), F.min(captured).alias("first"), F.max(captured).alias("last"), F.sum(material).cast("long").alias("material_changes"))
    days = F.floor((F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp"))) / F.lit(86_400_000_000)).cast("long")
    rate = (F.col("versions") - 1) / F.greatest(days, F.lit(1)) * 365
    risk = F.when((F.col("material_changes") >= 5) | (rate > 12), "H").when((F.col("material_changes") >= 2) | (rate > 6), "M").otherwise("L")
    return out.select(trial, "versions", rate.alias("changes_a_year"), "material_changes", risk.alias("risk"))


def describe(changes: Column) -> Column:
    """One line of text per severity, most severe first."""
    line = lambda s: F.when(F.exists(changes, lambda c: c["severity"] == s), F.concat(F.lit(f"{s}: "), F.array_join(F.transform(F.filter(changes, lambda c: c["severity"] == s), lambda c: c["path"]), ", ")))
    return F.concat_ws("; ", line("H"), line("M"), line("L"))
