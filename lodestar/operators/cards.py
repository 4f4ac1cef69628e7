"""Study cards as variants: fields by a table of paths, evidence, validation, metadata, enrichment and scores."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.stats import let

# Fields of a card with path, type and whether they must be there.
FIELDS = (
    ("nct_id", "trial.nct_id", "text", True),
    ("phase", "trial.phase", "text", True),
    ("indication", "trial.indication", "text", True),
    ("is_pivotal", "trial.is_pivotal", "boolean", True),
    ("sponsor", "trial.sponsor", "text", False),
    ("start_date", "trial.start_date", "date", False),
    ("completion_date", "trial.completion_date", "date", False),
    ("primary_endpoints", "primary_endpoints", "array", True),
    ("secondary_endpoints", "secondary_endpoints", "array", False),
    ("endpoint_changes", "endpoint_changes", "array", False),
    ("itt_definition", "populations.itt", "object", False),
    ("pp_definition", "populations.pp", "object", False),
    ("analysis_population", "populations.analysis_primary_on", "text", False),
    ("dropout_summary", "populations.dropout_summary", "object", False),
    ("missingness_summary", "populations.missingness_summary", "object", False),
    ("primary_results", "results.primary", "array", True),
    ("secondary_results", "results.secondary", "array", False),
    ("subgroup_results", "results.subgroups", "array", False),
    ("effect_sizes", "results.effect_sizes", "array", False),
    ("confidence_intervals", "results.confidence_intervals", "array", False),
    ("sample_size", "sample_size", "object", True),
    ("power_calculation", "sample_size.power", "number", False),
    ("imputation_method", "statistics.imputation_method", "text", False),
    ("multiplicity_adjustments", "statistics.multiplicity_adjustments", "object", False),
    ("alpha_spending", "statistics.alpha_spending", "object", False),
    ("randomization", "protocol.randomization", "object", False),
    ("blinding", "protocol.blinding", "object", False),
    ("interim_looks", "protocol.interim_looks", "array", False),
    ("dsmb_rules", "protocol.dsmb_rules", "object", False),
    ("protocol_changes", "protocol_changes", "array", False),
    ("contradictions", "contradictions", "array", False),
    ("risk_signals", "signals", "array", False),
    ("data_tables", "evidence.data_tables", "array", False),
    ("figure_references", "evidence.figures", "array", False),
    ("page_references", "evidence.pages", "array", False),
    ("quote_spans", "evidence.quote_spans", "array", False),
    ("journal_type", "publication.journal_type", "text", False),
    ("open_access", "publication.open_access", "boolean", False),
    ("publication_date", "publication.date", "date", False),
    ("doi", "publication.doi", "text", False),
    ("conflicts_of_interest", "conflicts.interest", "array", False),
    ("funding_sources", "conflicts.funding", "array", False),
    ("sponsor_role", "conflicts.sponsor_role", "text", False),
    ("limitations", "reviewer_notes.limitations", "array", False),
    ("oddities", "reviewer_notes.oddities", "array", False),
    ("geographic_outliers", "reviewer_notes.geographic_outliers", "array", False),
    ("unexplained_discrepancies", "reviewer_notes.discrepancies", "array", False),
)
# Keys that hold evidence; phases; penalties by level; marks from a score on.
EVIDENCE_KEYS = ("evidence", "loc", "text_preview", "source", "reference")
PHASES = ("1", "2", "3", "4", "1/2", "2/3", "1b", "2a", "2b")
PENALTIES = {"critical": 25, "error": 10, "warning": 2}
GRADES = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
# Fields that a raw card needs or may have, sponsors with experience, kinds of indication and phase.
NEEDED = ("study_id", "is_pivotal", "primary_type")
CORE = ("study_id", "is_pivotal", "primary_type", "arms", "analysis_plan")
EXTRA = ("primary_result", "subgroups", "inclusion_criteria", "exclusion_criteria", "secondary_endpoints", "safety_endpoints")
READ = tuple(dict.fromkeys((*CORE, *EXTRA, "indication", "phase", "sponsor", "drug_name", "analysis_plan.alpha", "analysis_plan.one_sided", "analysis_plan.planned_interims", "endpoint_changed_after_lpr")))
METADATA = ("trial_id", "is_pivotal", "indication", "phase", "sponsor", "drug_name", "primary_endpoint_type", "total_sample_size", "arm_count", "alpha", "one_sided", "planned_interims", "subgroup_count", "subgroup_types")
EXPERIENCED = (
    "merck", "pfizer", "novartis", "roche", "astrazeneca", "johnson & johnson", "abbvie", "gilead", "amgen", "eli lilly", "glaxosmithkline", "sanofi",
    "biogen", "regeneron", "bristol-myers squibb", "moderna", "biontech",
)
INDICATIONS = {
    "oncology": ("cancer", "tumor", "neoplasm", "carcinoma", "leukemia", "lymphoma"),
    "cardiovascular": ("cardio", "heart", "vascular", "stroke", "myocardial"),
    "neurology": ("neuro", "brain", "spinal", "cerebral", "cognitive"),
    "immunology": ("immune", "autoimmune", "inflammation", "rheumatoid"),
    "rare_disease": ("rare", "orphan", "genetic", "inherited"),
    "dermatology": ("skin", "dermat", "psoriasis", "eczema"),
    "respiratory": ("lung", "respiratory", "asthma", "copd"),
    "metabolic": ("diabetes", "obesity", "metabolic", "endocrine"),
}
PHASE_KINDS = {
    "early_development": ("phase_1", "phase_1b", "phase_2a"),
    "proof_of_concept": ("phase_2", "phase_2b"),
    "confirmatory": ("phase_3", "pivotal"),
    "post_approval": ("phase_4", "post_marketing"),
}
FOUND = "array<struct<field:string,path:string,type:string,value:string,status:string,confidence:double>>"
ISSUES = "array<struct<field:string,rule:string,level:string,message:string>>"
EVIDENCE = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("field", "field_path", "evidence_type", "value")]))


def _path(path: str) -> str:
    return "$" + "".join(f"['{k}']" for k in path.split("."))


def at(card: Column, path: str) -> Column:
    """The variant at a dotted path; null if a step is missing."""
    return F.try_variant_get(card, _path(path), "variant")


def kind_of(v: Column) -> Column:
    """text, number, boolean, array, object or null (JSON's null); null if there is nothing."""
    return let(F.schema_of_variant(v), _kind)


def _kind(k: Column) -> Column:
    return F.when(k == "VOID", "null").when(k == "STRING", "text").when(k == "BOOLEAN", "boolean").when(k.startswith("ARRAY"), "array").when(k.startswith("OBJECT"), "object").when(k.isNotNull(), "number")


def text_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _kind_and_text(v: Column) -> Column:
    return F.struct(kind_of(v).alias("kind"), text_of(v).alias("text"))


def truthy(v: Column) -> Column:
    """Whether a value is there and neither null, false, 0 nor empty."""

    return let(v, lambda x: let(_kind_and_text(x), _holds))


def _holds(x: Column) -> Column:
    k, s = x["kind"], x["text"]
    return F.coalesce(F.when(k == "text", s != "").when(k == "boolean", s == "true").when(k == "number", s.try_cast("double") != 0).when(k.isin("array", "object"), ~s.isin("[]", "{}")), F.lit(False))


def number_of(v: Column) -> Column:
    """A number, a text that is one, or a flag as 1 or 0; else null."""
    return let(v, lambda x: let(_kind_and_text(x), _number))


def _number(x: Column) -> Column:
    return F.when(x["kind"] == "boolean", F.when(x["text"] == "true", 1.0).otherwise(0.0)).when(x["kind"].isin("number", "text"), F.trim(x["text"]).try_cast("double"))


def whole_of(v: Column) -> Column:
    """A number cut to a whole one, a text of digits, or a flag; else null."""
    return let(v, lambda x: let(_kind_and_text(x), _whole))


def _whole(x: Column) -> Column:
    return F.when((x["kind"] == "text") & ~F.trim(x["text"]).rlike(r"^[+-]?\d+$"), F.lit(None)).otherwise(_number(x)).cast("long")


def size_of(v: Column) -> Column:
    """Elements of an array or entries of an object; 0 for anything else."""
    return F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")), F.size(F.try_variant_get(v, "$", "map<string,variant>")), F.lit(0))


def _entries(v: Column) -> Column:
    return F.coalesce(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<struct<key:string,value:variant>>"))


def _status(kind: Column, k: Column, s: Column) -> Column:
    """Status of a value of kind k and text s in a field of a kind."""
    number = k.isin("number", "boolean")
    found = (
        F.when(s.isNull(), "missing")
        .when(kind == "text", F.when(k != "text", "invalid").when(s.rlike(r"(?U)\S"), "extracted").otherwise("partial"))
        .when(kind == "number", F.when(number, "extracted").otherwise("missing"))
        .when(kind == "date", F.when(number | ((k == "text") & s.rlike(r"^(\d{4}|\d{2}/\d{2}/\d{4})")), "extracted").otherwise("invalid"))
        .when(k != kind, "invalid")
        .otherwise(F.when(s.isin("[]", "{}"), "partial").otherwise("extracted"))
    )
    return found


def _filled(card: Column) -> Column:
    """As truthy; a card with a known key is, whatever else it holds, so most cards are not written out as text."""
    heads = dict.fromkeys(p.split(".")[0] for _, p, _, _ in FIELDS)
    return reduce(lambda a, b: a | b, (at(card, h).isNotNull() for h in heads)) | truthy(card)


def fields(card: Column) -> Column:
    """Structs (field, path, type, value, status, confidence) of the fields a card has, and of required ones it lacks; none
    for a null or empty card.  A loop over the table of fields, so that the plan holds the rule once; only the values are read
    by constant paths, as others are parsed again for every row."""
    table = F.array(*(F.struct(F.lit(n).alias("field"), F.lit(p).alias("path"), F.lit(k).alias("type"), F.lit(r).alias("needed")) for n, p, k, r in FIELDS))
    values = F.array(*(at(card, p) for _, p, _, _ in FIELDS))

    def row(f, x):
        status = _status(f["type"], x["kind"], x["text"])
        confidence = lambda how: F.when(how == "extracted", 1.0).when(how == "partial", F.when(f["type"] == "text", 0.3).otherwise(0.5)).otherwise(0.0)
        made = let(status, lambda how: F.struct(f["field"].alias("field"), f["path"].alias("path"), f["type"].alias("type"), x["text"].alias("value"), how.alias("status"), confidence(how).alias("confidence")))
        return F.when(x["text"].isNotNull() | f["needed"], made)

    # what is neither there nor needed is left out before anything is worked out of it
    found = F.array_compact(F.zip_with(table, values, lambda f, v: F.when(v.isNotNull() | f["needed"], let(_kind_and_text(v), lambda x: row(f, x)))))
    return F.when(_filled(card), found).otherwise(F.array().cast(FOUND))


def fields_summary(found: Column) -> Column:
    """Struct of counts by status, mean confidence and completeness of what `fields` gives; zeros for none."""

    def of(found):
        n = F.size(found)
        count = lambda s: F.size(F.filter(found, lambda f: f["status"] == s))
        share = lambda x: F.coalesce(F.try_divide(x, n), F.lit(0.0))
        total = F.aggregate(found, F.lit(0.0), lambda a, f: a + f["confidence"])
        return F.struct(
            n.alias("total_fields"), *(count(s).alias(f"{s}_count") for s in ("extracted", "partial", "missing", "invalid")),
            share(count("extracted")).alias("extraction_rate"), share(total).alias("avg_confidence"), share(count("extracted") + count("partial") * 0.5).alias("completeness_score"),
        )

    return let(found, of)


def evidence_of(card: dict) -> list[dict]:
    """Evidence under the array and object fields of a parsed card, each key before what lies deeper."""
    out: list[dict] = []
    for name, path, kind, _ in FIELDS:
        value = reduce(lambda v, k: v.get(k) if isinstance(v, dict) else None, path.split("."), card)
        if kind not in ("array", "object") or not isinstance(value, dict | list):
            continue
        todo = [(value, path)]
        while todo:
            node, here = todo.pop()
            if isinstance(node, list):
                todo += [(x, f"{here}[{i}]") for i, x in reversed(list(enumerate(node))) if isinstance(x, dict)]
                continue
            for key in EVIDENCE_KEYS:
                if node.get(key):
                    said = node[key] if isinstance(node[key], str) else json.dumps(node[key])
                    out.append({"field": name, "field_path": here, "evidence_type": key, "value": said})
            todo += [(x, f"{here}.{k}") for k, x in reversed(list(node.items())) if isinstance(x, dict | list) and k not in EVIDENCE_KEYS]
    return out


@F.pandas_udf(EVIDENCE)
def evidence(card_text: pd.Series) -> pd.Series:
    """Structs (field, field_path, evidence_type, value) of a card's JSON text, at any depth; none for a text that is no
    object."""

    def one(text):
        try:
            card = json.loads(text) if text else None
        except ValueError:
            card = None
        return evidence_of(card) if isinstance(card, dict) else []

    return pd.Series([one(t) for t in card_text], dtype=object)


def _issue(field: str, rule: str, level: str, message) -> Column:
    said = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.lit(level).alias("level"), said.alias("message"))


def issues(card: Column, found: Column) -> Column:
    """Structs (field, rule, level, message): missing and malformed fields, fields without evidence, populations and counts
    that don't fit, weak evidence.  `found` is what `evidence` gives.  None for a null or empty card."""
    count = lambda v: F.when(kind_of(v) == "array", size_of(v)).otherwise(0)
    read = [(n, p, r) for n, p, _, r in FIELDS if r or n == "power_calculation"]
    itt, pp = at(card, "populations.itt"), at(card, "populations.pp")
    values = F.struct(
        *(let(at(card, p), _kind_and_text).alias(n) for n, p, _ in read), let(at(card, "sample_size.total_n"), _kind_and_text).alias("total_n"),
        truthy(itt).alias("itt"), truthy(pp).alias("pp"), ((kind_of(pp) == "object") & truthy(at(pp, "defined")) & truthy(at(pp, "criteria"))).alias("defined"),
        text_of(at(card, "populations.analysis_primary_on")).alias("on"), count(at(card, "primary_endpoints")).alias("ends"), count(at(card, "results.primary")).alias("results"),
    )
    every = let(F.struct(values.alias("v"), found.alias("e")), lambda x: F.array_compact(F.array(*_issues(x["v"], x["e"], [(n, r) for n, _, r in read]))))
    return F.when(_filled(card), every).otherwise(F.array().cast(ISSUES))


def _issues(v: Column, found: Column, read: list[tuple[str, bool]]) -> list[Column]:
    """Each issue or null, from what was read of a card once."""
    known = lambda x: x["text"].isNotNull()
    out = []
    for name, needed in read:
        x = v[name]
        s, k = x["text"], x["kind"]
        if needed:
            out.append(F.when(~known(x), _issue(name, "required_field", "error", f"Required field '{name}' is missing")))
        if name == "nct_id":
            out.append(F.when(known(x) & ~((k == "text") & s.rlike(r"^NCT\d{8}$")), _issue(name, "field_format", "error", "Invalid NCT ID format")))
        if name == "phase":
            out.append(F.when(known(x) & ~((k == "text") & s.isin(*PHASES)), _issue(name, "field_format", "warning", "Unusual trial phase value")))
        if name == "indication":
            out.append(F.when(known(x) & ~((k == "text") & F.length(F.trim(s)).between(3, 200)), _issue(name, "field_format", "warning", "Indication text may be too short or too long")))
        if name == "sample_size":
            n = v["total_n"]
            size = F.when((k == "object") & n["kind"].isNotNull(), F.when(n["kind"].isin("number", "boolean"), _number(n))).when(k.isin("number", "boolean"), _number(x))
            out.append(F.when(known(x) & ~F.coalesce(size > 0, F.lit(False)), _issue(name, "field_range", "error", "Invalid sample size value")))
        if name == "power_calculation":
            fit = k.isin("number", "boolean") & _number(x).between(0.5, 1.0)
            out.append(F.when(known(x) & ~F.coalesce(fit, F.lit(False)), _issue(name, "field_range", "warning", "Power calculation outside expected range")))
        if name in ("primary_endpoints", "primary_results"):
            out.append(F.when(F.size(F.filter(found, _of_field(name))) == 0, _issue(name, "evidence_presence", "warning", f"No evidence spans found for {name}")))
    out.append(F.when(v["itt"] & v["pp"] & (v["on"] == "PP") & ~v["defined"], _issue("population_consistency", "field_consistency", "warning", "PP population analysis without proper PP definition")))
    unlike = F.format_string("Mismatch between endpoints (%d) and results (%d)", v["ends"], v["results"])
    out.append(F.when(_holds(v["primary_endpoints"]) & _holds(v["primary_results"]) & (v["ends"] != v["results"]), _issue("endpoint_result_consistency", "field_consistency", "warning", unlike)))
    good = lambda e: e["evidence_type"].isin("loc", "source") | ((e["evidence_type"] == "text_preview") & (F.length(e["value"]) > 10))
    weak = F.try_divide(F.size(F.filter(found, lambda e: ~good(e))), F.size(found))
    out.append(F.when(weak > 0.3, _issue("evidence_quality", "evidence_presence", "warning", F.format_string("Low quality evidence detected (%.1f%%)", weak * 100))))
    return out


def _of_field(name: str):
    return lambda e: e["field"] == name


def grade(score: Column) -> Column:
    return reduce(lambda rest, g: F.when(score >= g[0], g[1]).otherwise(rest), reversed(GRADES), F.lit("F"))


def validation(found_issues: Column, summary: Column) -> Column:
    """Struct (total_issues, errors, warnings, score, grade, overall): penalties by level off 100; overall is 0.7 of that and
    0.3 of completeness, or the score alone if no field was found."""

    def of(x):
        count = lambda level: F.size(F.filter(x["issues"], lambda i: i["level"] == level))
        lost = reduce(lambda a, b: a + b, (count(level) * p for level, p in PENALTIES.items()))

        def marked(score):
            overall = F.when(x["summary"]["total_fields"] > 0, score * 0.7 + x["summary"]["completeness_score"] * 100 * 0.3).otherwise(score.cast("double"))
            return F.struct(F.size(x["issues"]).alias("total_issues"), count("error").alias("errors"), count("warning").alias("warnings"), score.alias("score"), grade(score).alias("grade"), overall.alias("overall"))

        return let(F.greatest(F.lit(0), F.lit(100) - lost), marked)

    return let(F.struct(found_issues.alias("issues"), summary.alias("summary")), of)


def card_errors(card: Column) -> Column:
    """Messages on a raw card: required fields, id, arms, plan, p-values, subgroups.  Arms and results in the order of
    their keys."""
    v = lambda path: at(card, path)
    none = F.array().cast("array<string>")
    lone = lambda when, said: F.when(F.coalesce(when, F.lit(False)), F.lit(said) if isinstance(said, str) else said)
    listed = lambda *c: F.array_compact(F.array(*c))
    known = lambda x: text_of(x).isNotNull()
    number = lambda x: F.when(known(x), number_of(x))

    def arm(e):
        n = at(e["value"], "n")
        whole, name = whole_of(n), F.concat(F.lit("Arm "), e["key"])
        bad = (
            F.when(kind_of(e["value"]) != "object", " must be a dictionary")
            .when(n.isNull(), " missing sample size (n)")
            .when(kind_of(n) == "null", F.lit(None))
            .when(whole.isNull(), " sample size must be a valid integer")
            .when(whole <= 0, " sample size must be positive")
            .when(whole > 100_000, " sample size too large (max 100,000)")
        )
        return F.concat(name, bad)

    def result(e):
        p = at(e["value"], "p")
        x = number_of(p)
        return (
            F.when(kind_of(e["value"]) != "object", F.concat(F.lit("Primary result "), e["key"], F.lit(" must be a dictionary")))
            .when(known(p) & x.isNull(), F.concat(F.lit("P-value in "), e["key"], F.lit(" must be a valid number")))
            .when(known(p) & ((x < 0) | (x > 1)), F.concat(F.lit("P-value in "), e["key"], F.lit(" must be between 0 and 1")))
        )

    def subgroup(s, i):
        name = F.concat(F.lit("Subgroup "), i.cast("string"))
        return F.concat(name, F.when(kind_of(s) != "object", " must be a dictionary").when(at(s, "name").isNull(), " missing name").when(at(s, "n").isNull(), " missing sample size"))

    study, arms, plan, results, groups = v("study_id"), v("arms"), v("analysis_plan"), v("primary_result"), v("subgroups")
    alpha, interims = at(plan, "alpha"), at(plan, "planned_interims")
    a, i = number(alpha), F.when(known(interims), whole_of(interims))
    in_plan = kind_of(plan) == "object"
    return F.concat(
        listed(*(F.when(~known(v(f)), F.lit(f"Missing required field: {f}")) for f in NEEDED)),
        listed(lone(truthy(study) & (F.trim(text_of(study)) == ""), "Study ID cannot be empty"), lone(truthy(study) & (F.trim(text_of(study)) != "") & (F.length(text_of(study)) > 100), "Study ID too long (max 100 characters)")),
        listed(lone(kind_of(arms) != "object", "Arms must be a dictionary"), lone((kind_of(arms) == "object") & (size_of(arms) == 0), "Arms dictionary cannot be empty")),
        F.array_compact(F.transform(_entries(arms), arm)),
        listed(
            lone(kind_of(plan) != "object", "Analysis plan must be a dictionary"),
            lone(in_plan & known(alpha) & a.isNull(), "Alpha must be a valid number"), lone(in_plan & ((a <= 0) | ((a >= 1) & ~F.isnan(a))), "Alpha must be between 0 and 1"),
            lone(in_plan & known(interims) & i.isNull(), "Planned interims must be a valid integer"), lone(in_plan & (i < 0), "Planned interims cannot be negative"), lone(in_plan & (i > 10), "Planned interims too high (max 10)"),
        ),
        listed(lone(kind_of(results) != "object", "Primary result must be a dictionary")),
        F.array_compact(F.transform(_entries(results), result)),
        listed(lone(kind_of(groups) != "array", "Subgroups must be a list")),
        F.coalesce(F.array_compact(F.transform(F.try_variant_get(groups, "$", "array<variant>"), subgroup)), none),
    )


def raw_values(card: Column) -> list[Column]:
    """What the rules below read of a raw card, each read once: by path its schema (path_k) and text (path_s), sizes of its
    objects and lists, and schemas and texts from under arms, results and subgroups."""
    kept = lambda v, name: (F.schema_of_variant(v).alias(f"{name}_k"), text_of(v).alias(f"{name}_s"))
    values = lambda path: F.map_values(F.try_variant_get(card, _path(path), "map<string,variant>"))
    under = lambda *names: lambda e: F.struct(*(c for n in names for c in kept(at(e, n), n)))
    return [
        *(c for p in READ for c in kept(at(card, p), p.replace(".", "_"))),
        *(size_of(at(card, p)).alias(f"{p}_size") for p in ("arms", "subgroups", "primary_result")),
        F.transform(values("arms"), under("n", "dropout")).alias("arm_values"), F.transform(values("primary_result"), under("p")).alias("result_values"),
        F.transform(F.try_variant_get(card, _path("subgroups"), "array<variant>"), lambda g: F.struct(F.schema_of_variant(g).alias("k"), text_of(at(g, "name")).alias("name"))).alias("subgroup_values"),
    ]


def _value(get, name: str) -> dict[str, Column]:
    """Kind and text of a value of raw_values; get gives a column by name."""
    return {"kind": _kind(get(f"{name}_k")), "text": get(f"{name}_s")}


def _there(get, name: str) -> Column:
    """_holds of a value of raw_values, told from its schema."""
    k, s = get(f"{name}_k"), get(f"{name}_s")
    return F.coalesce(F.when(k == "STRING", s != "").when(k == "BOOLEAN", s == "true").when(k.startswith("ARRAY") | k.startswith("OBJECT"), ~s.isin("[]", "{}")).when(k != "VOID", s.try_cast("double") != 0), F.lit(False))


def _from(card: Column, rule) -> Column:
    """A rule on raw_values as an expression of the card alone."""
    return let(F.struct(*raw_values(card)), lambda x: rule(lambda name: x[name]))


def _metadata(get) -> dict[str, Column]:
    value = lambda name: _value(get, name)
    said = lambda c: F.coalesce(get(f"{c}_s"), F.lit("unknown"))
    arms, groups = value("arms")["kind"], value("subgroups")["kind"]
    whole = lambda a, e: a + F.when(e["n_k"].isNotNull(), F.coalesce(_whole(_value(lambda n: e[n], "n")), F.lit(0))).otherwise(0)
    total = F.aggregate(F.coalesce(get("arm_values"), F.array().cast("array<struct<n_k:string,n_s:string,dropout_k:string,dropout_s:string>>")), F.lit(0).cast("long"), whole)
    names = F.transform(F.filter(get("subgroup_values"), lambda g: _kind(g["k"]) == "object"), lambda g: F.coalesce(g["name"], F.lit("unknown")))
    return {
        "trial_id": get("study_id_s"), "is_pivotal": _there(get, "is_pivotal"), **{c: said(c) for c in ("indication", "phase", "sponsor", "drug_name")}, "primary_endpoint_type": said("primary_type"),
        "total_sample_size": F.when(arms == "object", total), "arm_count": F.when(arms == "object", get("arms_size")),
        "alpha": _number(value("analysis_plan_alpha")), "one_sided": _there(get, "analysis_plan_one_sided"),
        "planned_interims": F.coalesce(_whole(value("analysis_plan_planned_interims")), F.lit(0)),
        "subgroup_count": F.when(groups == "array", get("subgroups_size")), "subgroup_types": names,
    }


def _struct(columns: dict[str, Column]) -> Column:
    return F.struct(*(c.alias(n) for n, c in columns.items()))


def metadata(card: Column) -> Column:
    """Struct of a raw card's trial, arms and plan; texts that aren't there are `unknown`."""
    return _from(card, lambda get: _struct(_metadata(get)))


def _completeness(get) -> Column:
    share = lambda names: reduce(lambda a, b: a + b, (_there(get, c).cast("int") for c in names)) / len(names)
    return share(CORE) * 0.7 + share(EXTRA) * 0.3


def completeness(card: Column) -> Column:
    """0.7 of the share of core fields that hold something, 0.3 of that of the others."""
    return _from(card, _completeness)


def _data_quality(get) -> Column:
    odd = lambda k: F.when(k.isNotNull() & ~_kind(k).isin("number", "boolean"), 1).otherwise(0)
    out = lambda k, x, low: F.when(k.isNotNull(), F.coalesce(low(_number(x)), F.lit(True)).cast("int")).otherwise(0)
    counted = lambda values, add: F.coalesce(F.aggregate(values, F.lit(0), lambda a, e: a + add(e)), F.lit(0))
    arms = counted(get("arm_values"), lambda e: odd(e["n_k"]) + odd(e["dropout_k"]))
    alpha = F.when(_value(get, "analysis_plan")["kind"] == "object", out(get("analysis_plan_alpha_k"), _value(get, "analysis_plan_alpha"), lambda x: (x <= 0) | (x >= 1))).otherwise(0)
    p = counted(get("result_values"), lambda e: out(e["p_k"], _value(lambda n: e[n], "p"), lambda x: (x < 0) | (x > 1)))
    return F.greatest(F.lit(0.0), F.round(F.lit(1.0) - arms * 0.1 - (alpha + p) * 0.2, 9))


def data_quality(card: Column) -> Column:
    """1 less 0.1 for every size or dropout of an arm that's no number, 0.2 for an alpha and each p-value out of range."""
    return _from(card, _data_quality)


def _noted(get) -> list[Column]:
    """What enrichment tells of raw_values and of the columns of _metadata."""
    holds = lambda words: reduce(lambda a, b: a | b, (F.lower(get("indication")).contains(w) for w in words))
    plan = get("planned_interims")
    n, groups = F.coalesce(get("total_sample_size"), F.lit(0)), F.coalesce(get("subgroup_count"), F.lit(0))
    risks = F.array_compact(
        F.array(
            F.when(n < 100, F.lit("small_sample_size")).when(n > 10_000, F.lit("very_large_sample_size")), F.when(plan > 3, F.lit("multiple_interim_analyses")),
            F.when(groups > 5, F.lit("many_subgroups")), F.when(_there(get, "endpoint_changed_after_lpr"), F.lit("endpoint_changed_after_lpr")),
        )
    )
    return [
        F.when(F.lower(get("sponsor")).isin(*EXPERIENCED), "experienced").otherwise("novice").alias("sponsor_experience"),
        reduce(lambda rest, k: F.when(holds(INDICATIONS[k]), k).otherwise(rest), reversed(list(INDICATIONS)), F.lit("other")).alias("indication_category"),
        reduce(lambda rest, k: F.when(F.lower(get("phase")).isin(*PHASE_KINDS[k]), k).otherwise(rest), reversed(list(PHASE_KINDS)), F.lit("unknown")).alias("phase_category"),
        F.when(groups > 3, "complex").when(get("primary_result_size") > 2, "moderate").otherwise("simple").alias("endpoint_complexity"),
        F.when(plan > 2, "complex").when(plan > 0, "moderate").otherwise("simple").alias("statistical_complexity"),
        risks.alias("risk_factors"),
        _completeness(get).alias("completeness"), _data_quality(get).alias("data_quality"),
    ]


def enrichment(card: Column) -> Column:
    """Struct of what a raw card says of its sponsor, indication, phase, complexity, risks and quality."""
    return _from(card, lambda get: let(_struct(_metadata(get)), lambda m: F.struct(*_noted(lambda name: m[name] if name in METADATA else get(name)))))


def with_metadata(df: DataFrame, card: str, *keep: str) -> DataFrame:
    """The columns `keep` and those of `metadata`, in projections that follow each other, so that each value is worked out once."""
    return df.select(*keep, *raw_values(F.col(card))).select(*keep, *(c.alias(n) for n, c in _metadata(F.col).items()))


def with_enrichment(df: DataFrame, card: str, *keep: str) -> DataFrame:
    """The columns `keep` and those of `enrichment`, as with_metadata."""
    told = df.select(*keep, *raw_values(F.col(card)))
    own = {n: c.alias(f"m_{n}") for n, c in _metadata(F.col).items() if n not in ("subgroup_types", "arm_count", "alpha", "one_sided")}
    return told.select("*", *own.values()).select(*keep, *_noted(lambda name: F.col(f"m_{name}" if name in METADATA else name)))
