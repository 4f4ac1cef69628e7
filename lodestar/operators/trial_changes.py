"""Typed changes between two versions of a trial, in nine groups of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_CHANGE = 0.1
#: One version of a trial.
FIELDS = (
    "struct<brief_title:string,phase:string,status:string,lead_sponsor_name:string,collaborators:array<string>,allocation:string,masking:string,"
    "interventions:array<struct<name:string,type:string>>,primary_outcomes:array<struct<measure:string,time_frame:string>>,enrollment:bigint,"
    "alpha_level:double,power:double,study_start_date:date,primary_completion_date:date,locations:array<string>>"
)
CHANGE = "struct<field:string,change_type:string,old:string,new:string,significance:string,description:string>"


def _change(field: Column | str, kind: str, old: Column, new: Column, significance: str, said: Column | str) -> Column:
    text = lambda c: F.lit(c) if isinstance(c, str) else c
    return F.struct(text(field).alias("field"), F.lit(kind).alias("change_type"), old.cast("string").alias("old"), new.cast("string").alias("new"), F.lit(significance).alias("significance"), text(said).alias("description"))


def _plain(field: str, old: Column, new: Column, significance: str, said: str) -> Column:
    return F.when(~old.eqNullSafe(new), _change(field, "MODIFIED", old, new, significance, said))


def _share(old: Column, new: Column) -> Column:
    return F.abs(new - old).cast("double") / old


def _percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def endpoint_text(outcomes: Column) -> Column:
    """Measures with their time frames, as one text; outcomes without a measure are left out."""
    filled = F.filter(outcomes, lambda o: F.coalesce(o["measure"], F.lit("")) != "")
    one = lambda o: F.when(F.coalesce(o["time_frame"], F.lit("")) != "", F.concat(o["measure"], F.lit(" ("), o["time_frame"], F.lit(")"))).otherwise(o["measure"])
    return F.coalesce(F.array_join(F.transform(filled, one), "; "), F.lit(""))


def _members(field: str, old: Column, new: Column, significance: str, what: str) -> list[Column]:
    """Changes of a collection with names: added and removed ones."""
    empty = F.lit(None)
    added = F.transform(F.array_except(new, old), lambda n: _change(field, "ADDED", empty, n, significance, F.concat(F.lit(f"New {what} added: "), n)))
    removed = F.transform(F.array_except(old, new), lambda n: _change(field, "REMOVED", n, empty, significance, F.concat(F.lit(f"{what.capitalize()} removed: "), n)))
    return [added, removed]


def detect_changes(old: Column, new: Column, numeric_change: float = NUMERIC_CHANGE) -> Column:
    """Array of CHANGE of two versions (FIELDS): basic fields, sponsor, design, interventions, outcomes, enrolment, statistics,
    dates and locations, in this order.

    Interventions are matched by name (of several with one name the last counts) and then compared by type; locations
    and collaborators are sets.  Numbers change from a relative difference of `numeric_change` on; enrolment also
    where one side is missing or 0, power only where both are there.  Names that are null are left out.
    """
    strings = lambda c: F.array_distinct(F.filter(F.coalesce(c, F.expr("array()").cast("array<string>")), lambda x: x.isNotNull()))
    col = lambda f: (old[f], new[f])
    one = [
        _plain("brief_title", *col("brief_title"), "LOW", "Brief title changed"),
        _plain("phase", *col("phase"), "HIGH", "Trial phase changed"),
        _plain("status", *col("status"), "HIGH", "Trial status changed"),
        _plain("sponsor_info.lead_sponsor_name", *col("lead_sponsor_name"), "MEDIUM", "Lead sponsor name changed"),
    ]
    a, b = (strings(c) for c in col("collaborators"))
    joined = lambda c: F.array_join(F.array_sort(c), ", ")
    for verb, names in (("added", F.array_except(b, a)), ("removed", F.array_except(a, b))):
        one.append(F.when(F.size(names) > 0, _change("sponsor_info.collaborators", "MODIFIED", joined(a), joined(b), "MEDIUM", F.concat(F.lit(f"Collaborators {verb}: "), joined(names)))))
    one += [_plain("trial_design.allocation", *col("allocation"), "HIGH", "Trial allocation method changed"), _plain("trial_design.masking", *col("masking"), "HIGH", "Trial masking/blinding changed")]
    was, now = (F.coalesce(c, F.expr("array()").cast("array<struct<name:string,type:string>>")) for c in col("interventions"))
    names = lambda c: strings(F.transform(c, lambda x: x["name"]))
    kind = lambda c, n: F.try_element_at(F.filter(c, lambda x: x["name"] == n), F.lit(-1))["type"]
    retyped = F.filter(F.array_intersect(names(was), names(now)), lambda n: ~kind(was, n).eqNullSafe(kind(now, n)))
    modified = F.transform(retyped, lambda n: _change(F.concat(F.lit("interventions."), n, F.lit(".type")), "MODIFIED", kind(was, n), kind(now, n), "MEDIUM", F.concat(F.lit("Intervention type changed for "), n)))
    two = [_plain("primary_endpoint_text", endpoint_text(old["primary_outcomes"]), endpoint_text(new["primary_outcomes"]), "HIGH", "Primary endpoint changed")]
    a, b = col("enrollment")
    there = (F.coalesce(a, F.lit(0)) != 0) & (F.coalesce(b, F.lit(0)) != 0)
    sized = F.when(there & (_share(a, b) >= numeric_change), _change("enrollment_info.count", "MODIFIED", a, b, "MEDIUM", F.concat(F.lit("Sample size changed by "), _percent(_share(a, b)))))
    two.append(F.when(~a.eqNullSafe(b), F.when(there, sized).otherwise(_change("enrollment_info.count", "MODIFIED", a, b, "MEDIUM", "Sample size information changed"))))
    two.append(_plain("statistical_analysis.alpha_level", *col("alpha_level"), "HIGH", "Alpha level changed"))
    a, b = col("power")
    there = (F.coalesce(a, F.lit(0.0)) != 0) & (F.coalesce(b, F.lit(0.0)) != 0)
    two.append(F.when(there & (a != b) & (_share(a, b) >= numeric_change), _change("statistical_analysis.power", "MODIFIED", a, b, "HIGH", F.concat(F.lit("Statistical power changed by "), _percent(_share(a, b))))))
    two.append(_plain("study_start_date", *col("study_start_date"), "MEDIUM", "Study start date changed"))
    two.append(_plain("primary_completion_date", *col("primary_completion_date"), "MEDIUM", "Primary completion date changed"))
    places = _members("locations", *(strings(c) for c in col("locations")), "LOW", "location")
    return F.concat(F.array_compact(F.array(*one)), *_members("interventions", names(was), names(now), "MEDIUM", "intervention"), modified, F.array_compact(F.array(*two)), *places)


def significant(changes: Column) -> Column:
    """Whether a change is of high or medium significance."""
    return F.exists(changes, lambda c: c["significance"].isin("HIGH", "MEDIUM"))


def change_text(changes: Column) -> Column:
    """The changes as lines of text, by significance."""

    def lines(level: str) -> Column:
        own = F.filter(changes, lambda c: c["significance"] == level)
        body = F.array_join(F.transform(own, lambda c: F.concat(F.lit("  • "), c["field"], F.lit(": "), c["description"])), "\n")
        return F.when(F.size(own) > 0, F.concat(F.lit(f"\n{level} significance ("), F.size(own).cast("string"), F.lit("):\n"), body))

    head = F.concat(F.lit("Detected "), F.size(changes).cast("string"), F.lit(" changes:"))
    return F.when(F.size(changes) == 0, "No changes detected").otherwise(F.concat_ws("\n", head, *map(lines, ("HIGH", "MEDIUM", "LOW"))))
