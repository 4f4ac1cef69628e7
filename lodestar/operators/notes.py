"""Notes on a study's text: conflicts, funding, journal, tables, figures, quotes, and a reviewer's remarks.

All are expressions over one row.  Offsets are 0-based code points, ends exclusive; a null text is an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.stats import let
from lodestar.operators.analysis import publication_confidence
from lodestar.operators.filings import value_at

# Wording of conflicts, funding and kinds of journal.
CONFLICTS = {
    "financial": (
        r"\b(consulting\s+fees?|honoraria|speakers?\s+bureau|advisory\s+board)\b",
        r"\b(stock\s+options?|equity|ownership|financial\s+interest)\b",
        r"\b(grant|funding|sponsorship|research\s+support)\b",
    ),
    "employment": (r"\b(employee|employment|salary|compensation)\b", r"\b(consultant|advisor|expert|witness)\b"),
    "patents": (r"\b(patent|inventor|intellectual\s+property|IP)\b", r"\b(licensing|royalties|commercialization)\b"),
}
FUNDING = {
    "industry": (r"\b(pharmaceutical|biotech|company|corporation|inc\.|ltd\.)\b", r"\b(industry\s+sponsored|commercial\s+sponsor)\b"),
    "government": (r"\b(NIH|NSF|FDA|CDC|government|federal|national)\b", r"\b(grants?|funding|support)\b"),
    "academic": (r"\b(university|college|institution|academic|research)\b", r"\b(endowment|foundation|trust)\b"),
}
JOURNALS = {
    "high_impact": (r"\b(Nature|Science|Cell|NEJM|Lancet|JAMA|BMJ)\b", r"\b(impact\s+factor\s*[>≥]\s*\d+)\b"),
    "specialty": (r"\b(Journal\s+of|J\.|Annals\s+of|Archives\s+of)\b", r"\b(specialty|specialized|field-specific)\b"),
    "conference": (r"\b(conference|proceedings|abstract|poster|presentation)\b", r"\b(ASCO|ASH|AACR|ESMO|ASCO-GI)\b"),
}
IMPACT_FACTOR = (r"impact\s+factor\s*[=:]\s*(\d+\.?\d*)", r"IF\s*[=:]\s*(\d+\.?\d*)", r"(\d+\.?\d*)\s*impact\s+factor")
OPEN_ACCESS = (r"\bopen\s+access\b", r"\bOA\b", r"\bfree\s+access\b", r"\bpublicly\s+available\b")
PAYWALL = (r"\bpaywall\b", r"\bsubscription\s+required\b", r"\bpay\s+per\s+view\b")
PEER_REVIEW = (r"\bpeer\s+reviewed\b", r"\bpeer\s+review\b", r"\brefereed\b")
PREPRINT = (r"\bpreprint\b", r"\bmedRxiv\b", r"\bbioRxiv\b", r"\barXiv\b")
NAMES = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b"
GRANTS = (r"\b[A-Z]{2,4}\d{4,6}\b", r"\b\d{2}[A-Z]{2,4}\d{4,6}\b", r"\b[A-Z]{2,4}-\d{4,6}\b")
# References to tables and figures, quotes, and words that say what they hold.
TABLES = (r"\bTable\s+(\d+[A-Z]?)\b", r"\bTable\s+(\d+[A-Z]?)\s*[:.]\s*([^.\n]+)", r"\b(Tab\.?\s+\d+[A-Z]?)\b")
FIGURES = (r"\bFigure\s+(\d+[A-Z]?)\b", r"\bFigure\s+(\d+[A-Z]?)\s*[:.]\s*([^.\n]+)", r"\b(Fig\.?\s+\d+[A-Z]?)\b")
QUOTES = (r'"([^"]{20,100})"', r"'([^']{20,100})'", r"``([^`]{20,100})``")
TABLE_DATA = {
    "demographics": ("demographic", "baseline", "characteristic"),
    "efficacy": ("efficacy", "outcome", "endpoint", "result"),
    "safety": ("safety", "adverse", "toxicity", "side effect"),
    "subgroup": ("subgroup",),
}
FIGURE_DATA = {
    "survival": ("survival", "kaplan", "meier"),
    "efficacy": ("efficacy", "outcome", "endpoint"),
    "safety": ("safety", "adverse", "toxicity"),
    "subgroup": ("subgroup",),
    "patient_flow": ("patient", "flow", "consort"),
}
FIGURE_KINDS = {
    "kaplan_meier": ("kaplan", "meier", "survival", "km"),
    "forest_plot": ("forest", "plot", "meta"),
    "waterfall": ("waterfall", "response"),
    "scatter": ("scatter", "correlation"),
    "bar_chart": ("bar", "chart", "histogram"),
    "flow_diagram": ("flow", "diagram", "consort"),
}
QUOTE_KINDS = {
    "interpretation": ("conclude", "suggest", "indicate", "demonstrate"),
    "limitation": ("limit", "constraint", "caveat", "caution"),
    "conclusion": ("therefore", "thus", "hence", "consequently"),
}
# A reviewer's patterns.
LIMITATIONS = {
    "study_design": (
        r"\b(single\s+arm|non\s+randomized|open\s+label|unblinded)\b",
        r"\b(historical\s+control|retrospective|observational)\b",
        r"\b(exploratory|pilot|feasibility|phase\s+1)\b",
        r"\b(limited\s+power|underpowered|small\s+sample)\b",
    ),
    "sample_size": (
        r"\b(small\s+sample|limited\s+power|underpowered)\b",
        r"\b(insufficient\s+power|low\s+power|power\s+calculation)\b",
        r"\b(sample\s+size\s+limitation|n\s*[<≤]\s*\d+)\b",
    ),
    "follow_up": (
        r"\b(short\s+follow\s+up|limited\s+follow\s+up)\b",
        r"\b(insufficient\s+follow\s+up|early\s+termination)\b",
        r"\b(loss\s+to\s+follow\s+up|dropout|attrition)\b",
    ),
    "endpoints": (
        r"\b(surrogate\s+endpoint|intermediate\s+endpoint)\b",
        r"\b(endpoint\s+change|protocol\s+amendment)\b",
        r"\b(composite\s+endpoint|multiple\s+endpoints)\b",
    ),
    "analysis": (
        r"\b(post\s+hoc|exploratory\s+analysis)\b",
        r"\b(missing\s+data|imputation|sensitivity\s+analysis)\b",
        r"\b(subgroup\s+analysis|interaction\s+test)\b",
    ),
    "generalizability": (
        r"\b(limited\s+generalizability|narrow\s+population)\b",
        r"\b(specific\s+population|restricted\s+cohort)\b",
        r"\b(geographic\s+limitation|single\s+center)\b",
    ),
}
ODDITIES = {
    "statistical": (
        r"\b(p\s*[<≤]\s*0\.001|highly\s+significant)\b",
        r"\b(effect\s+size\s+anomaly|outlier|extreme\s+value)\b",
        r"\b(statistical\s+power\s+issue|multiple\s+testing)\b",
        r"\b(confidence\s+interval\s+wide|large\s+standard\s+error)\b",
    ),
    "clinical": (
        r"\b(unexpected\s+outcome|paradoxical\s+result)\b",
        r"\b(adverse\s+event\s+pattern|safety\s+signal)\b",
        r"\b(clinical\s+relevance|meaningful\s+change)\b",
        r"\b(patient\s+population\s+mismatch|enrollment\s+issue)\b",
    ),
    "regulatory": (
        r"\b(protocol\s+violation|deviation|non\s+compliance)\b",
        r"\b(regulatory\s+requirement|FDA\s+guidance)\b",
        r"\b(approval\s+process|regulatory\s+pathway)\b",
    ),
    "methodological": (
        r"\b(method\s+change|procedure\s+modification)\b",
        r"\b(quality\s+control|validation\s+issue)\b",
        r"\b(measurement\s+error|bias|confounding)\b",
    ),
    "reporting": (
        r"\b(incomplete\s+reporting|missing\s+data)\b",
        r"\b(inconsistent\s+reporting|data\s+mismatch)\b",
        r"\b(transparency\s+issue|disclosure\s+gap)\b",
    ),
}
REGIONS = (
    r"\b(United\s+States|US|USA|America)\b",
    r"\b(Europe|European|EU|European\s+Union)\b",
    r"\b(Asia|Asian|China|Japan|India)\b",
    r"\b(Latin\s+America|South\s+America|Brazil|Argentina)\b",
    r"\b(Africa|African|South\s+Africa|Nigeria)\b",
    r"\b(Australia|Australian|Oceania)\b",
)
DISCREPANCIES = {
    "numbers": (r"\b(discrepancy|mismatch|inconsistency)\b", r"\b(different\s+number|conflicting\s+data)\b", r"\b(registry\s+vs\s+publication|trial\s+vs\s+paper)\b"),
    "dates": (r"\b(date\s+mismatch|timeline\s+discrepancy)\b", r"\b(completion\s+date|enrollment\s+date)\b", r"\b(protocol\s+amendment\s+date|change\s+date)\b"),
    "demographics": (r"\b(demographic\s+mismatch|population\s+difference)\b", r"\b(age\s+range|gender\s+distribution)\b", r"\b(ethnicity|race|geographic\s+distribution)\b"),
    "outcomes": (r"\b(outcome\s+mismatch|result\s+discrepancy)\b", r"\b(efficacy\s+data|safety\s+data)\b", r"\b(primary\s+vs\s+secondary|ITT\s+vs\s+PP)\b"),
}
# Pairs of sources by kind of discrepancy and the words that name them; the last of a kind needs none.
SOURCES = {
    "numbers": ((("registry", "publication"), ("Registry", "Publication")), (("trial", "paper"), ("Trial data", "Publication")), ((), ("Source 1", "Source 2"))),
    "dates": ((("protocol", "amendment"), ("Original protocol", "Amended protocol")), (("enrollment", "completion"), ("Enrollment date", "Completion date")), ((), ("Date 1", "Date 2"))),
    "demographics": ((("itt", "pp"), ("ITT population", "PP population")), ((), ("Population 1", "Population 2"))),
    "outcomes": ((("primary", "secondary"), ("Primary endpoint", "Secondary endpoint")), ((), ("Outcome 1", "Outcome 2"))),
}
SPAN = "array<struct<value:string,start:int,end:int>>"


def spans(text: Column, pattern: str | Column, any_case: bool = True) -> Column:
    """Matches of a pattern in order, as structs (value, start, end).

    The text between matches and the matches themselves give the offsets, so no Python is needed.
    """
    rule = F.concat(F.lit("(?iuU)" if any_case else "(?U)"), F.lit(pattern))
    t = F.coalesce(text, F.lit(""))
    return let(F.regexp_extract_all(t, rule, 0), lambda values: _placed(t, rule, values))


def _placed(t: Column, rule: Column, values: Column) -> Column:
    """Spans of all matches of a rule in a text."""
    pieces = F.arrays_zip(F.slice(F.split(t, rule, -1), 1, F.size(values)).alias("before"), values.alias("value"))

    def step(done: Column, piece: Column) -> Column:
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0)) + F.length(piece["before"])
        return F.concat(done, F.array(F.struct(piece["value"].alias("value"), start.alias("start"), (start + F.length(piece["value"])).alias("end"))))

    return F.when(F.size(values) == 0, F.array().cast(SPAN)).otherwise(F.aggregate(pieces, F.array().cast(SPAN), step))


def _matches(text: Column, patterns: dict[str, tuple[str, ...]], row) -> Column:
    """row(kind, span) for every match, kind by kind and pattern by pattern; a loop over the table of patterns, so that
    the plan holds the rule once. Only the matches are sought with constant patterns, as others are compiled again for
    every row; places are worked out where there are any."""
    rules = [(kind, "(?iuU)" + p) for kind, ps in patterns.items() for p in ps]
    table = F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(p).alias("rule")) for kind, p in rules))
    t = F.coalesce(text, F.lit(""))
    values = F.array(*(F.regexp_extract_all(t, F.lit(p), 0) for _, p in rules))
    each = lambda k, v: F.transform(_placed(t, k["rule"], v), lambda m: F.struct(k["kind"].alias("kind"), m["value"].alias("value"), m["start"].alias("start"), m["end"].alias("end")))
    return F.transform(F.flatten(F.zip_with(table, values, each)), lambda m: row(m["kind"], m))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _around(text: Column, m: Column, reach: int) -> Column:
    start = F.greatest(m["start"] - reach, F.lit(0))
    return F.substring(F.coalesce(text, F.lit("")), start + 1, m["end"] + reach - start)


def _holds(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))


def _first_kind(text: Column, kinds: dict[str, tuple[str, ...]], otherwise: str) -> Column:
    return reduce(lambda rest, k: F.when(_holds(text, kinds[k]), k).otherwise(rest), reversed(list(kinds)), F.lit(otherwise))


def _all_kinds(text: Column, kinds: dict[str, tuple[str, ...]]) -> Column:
    found = F.array_compact(F.array(*(F.when(_holds(text, words), F.lit(k)) for k, words in kinds.items())))
    return let(found, lambda f: F.when(F.size(f) == 0, F.array(F.lit("other"))).otherwise(f))


def _seen(text: Column, patterns: tuple[str, ...]) -> Column:
    t = F.coalesce(text, F.lit(""))
    return reduce(lambda a, b: a | b, (t.rlike("(?iuU)" + p) for p in patterns))


def conflicts(text: Column) -> Column:
    """Structs (type, description, entities, start, end): at most five distinct capitalised names, in order."""

    def row(kind, m):
        names = F.slice(F.array_distinct(F.regexp_extract_all(m["value"], F.lit("(?U)" + NAMES), 0)), 1, 5)
        return F.struct(kind.alias("type"), m["value"].alias("description"), names.alias("entities"), m["start"].alias("start"), m["end"].alias("end"))

    return _matches(text, CONFLICTS, row)


def funding(text: Column) -> Column:
    """Structs (type, entity, grant_number, start, end): the first capitalised name of a match or `Unknown`."""

    def row(kind, m):
        first = lambda p: F.nullif(F.regexp_extract(m["value"], "(?U)" + p, 0), F.lit(""))
        entity = F.coalesce(first(NAMES), F.lit("Unknown"))
        return F.struct(kind.alias("type"), entity.alias("entity"), F.coalesce(*map(first, GRANTS)).alias("grant_number"), m["start"].alias("start"), m["end"].alias("end"))

    return _matches(text, FUNDING, row)


def publication(text: Column, url: Column, source_id: Column, year: Column) -> Column:
    """Struct of a publication's journal, impact factor, access, review, date, DOI (of the address), PMID and confidence."""
    kind = reduce(lambda rest, k: F.when(_seen(text, JOURNALS[k]), k).otherwise(rest), reversed(list(JOURNALS)), F.lit("general"))
    group = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    impact = F.coalesce(*(group(text, "(?iuU)" + p).try_cast("double") for p in IMPACT_FACTOR))
    either = lambda yes, no: F.when(_seen(text, yes), True).when(_seen(text, no), False)
    base = F.struct(
        kind.alias("journal_type"), source_id.alias("journal_name"), impact.alias("impact_factor"), either(OPEN_ACCESS, PAYWALL).alias("open_access"), either(PEER_REVIEW, PREPRINT).alias("peer_reviewed"),
        year.cast("string").alias("publication_date"), group(url, r"(?U)doi\.org/([^/\s]+)").alias("doi"), group(text, r"(?U)\bPMID\s*[=:]\s*(\d+)\b").alias("pmid"),
    )
    return let(base, lambda b: b.withField("confidence", publication_confidence(b["journal_type"], b["journal_name"], b["impact_factor"], b["open_access"])))


def _references(text: Column, patterns: tuple[str, ...], word: str, row) -> Column:
    def one(pattern):
        rule = "(?iuU)" + pattern

        def of(m):
            label = F.regexp_extract(m["value"], rule, 1)
            caption = F.regexp_extract(m["value"], rule, 2) if pattern.count("(") == 2 else F.concat(F.lit(f"{word} "), label)
            return let(F.struct(label.alias("label"), caption.alias("caption"), m["start"].alias("start"), m["end"].alias("end")), row)

        return F.transform(spans(text, pattern), of)

    return F.concat(*map(one, patterns))


def table_references(text: Column) -> Column:
    """Structs (label, caption, data_types, start, end); a table with a caption is met by two patterns and told twice."""

    def row(r):
        return F.struct(r["label"].alias("label"), r["caption"].alias("caption"), _all_kinds(F.lower(r["caption"]), TABLE_DATA).alias("data_types"), r["start"].alias("start"), r["end"].alias("end"))

    return _references(text, TABLES, "Table", row)


def figure_references(text: Column) -> Column:
    """Structs (label, caption, figure_type, data_types, start, end)."""

    def row(r):
        low = F.lower(r["caption"])
        return F.struct(r["label"].alias("label"), r["caption"].alias("caption"), _first_kind(low, FIGURE_KINDS, "other").alias("figure_type"), _all_kinds(low, FIGURE_DATA).alias("data_types"), r["start"].alias("start"), r["end"].alias("end"))

    return _references(text, FIGURES, "Figure", row)


def quote_type(quote: Column) -> Column:
    return F.when(quote.rlike(r"(?U)\d"), "numeric").otherwise(_first_kind(F.lower(quote), QUOTE_KINDS, "qualitative"))


def quotes(text: Column, most: int = 20) -> Column:
    """Structs (text, context, data_type, start, end) of quoted text of 20 to 100 characters; the first `most`."""

    def row(m, pattern):
        said = F.regexp_extract(m["value"], "(?U)" + pattern, 1)
        return F.struct(said.alias("text"), _strip(_around(text, m, 100)).alias("context"), quote_type(said).alias("data_type"), m["start"].alias("start"), m["end"].alias("end"))

    of = lambda p: F.transform(spans(text, p, any_case=False), lambda m: row(m, p))
    return F.slice(F.concat(*map(of, QUOTES)), 1, most)


def severity(kind: Column, description: Column, context: Column) -> Column:
    """Severity of a limitation from its words, those around it, and its kind."""
    said, near = F.lower(description), F.lower(context)
    return (
        F.when(_holds(said, ("terminated", "stopped", "failed")) | _holds(near, ("critical", "severe", "major", "significant")), "critical")
        .when(_holds(said, ("underpowered", "small sample", "insufficient")) | kind.isin("sample_size", "follow_up"), "major")
        .when(_holds(said, ("limited", "restricted", "narrow")) | kind.isin("endpoints", "analysis"), "moderate")
        .otherwise("minor")
    )


def region_impact(context: Column) -> Column:
    low = F.lower(context)
    return F.when(_holds(low, ("significant", "major", "important", "key")), "significant").when(_holds(low, ("moderate", "some", "partial")), "moderate").otherwise("minimal")


def sources(kind: Column, context: Column) -> Column:
    """Struct (source1, source2) that a discrepancy of a kind is between."""
    low = F.lower(context)
    cases = [(k, words, pair) for k, of in SOURCES.items() for words, pair in of]
    pair = lambda names: F.struct(F.lit(names[0]).alias("source1"), F.lit(names[1]).alias("source2"))
    named = lambda k, words: reduce(lambda a, w: a & low.contains(w), words, kind == k)
    return reduce(lambda rest, c: F.when(named(c[0], c[1]), pair(c[2])).otherwise(rest), reversed(cases), pair(("Source 1", "Source 2")))


def _items(card: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(card, f"$.{path}", "array<variant>"), F.array().cast("array<variant>"))


def structural_limitations(card: Column) -> Column:
    """Structs (type, description, severity, start, end, preview) from a card's size, power, status and endpoints; no offsets."""
    none = F.lit(None).cast("int")
    row = lambda kind, said, how, seen: F.struct(F.lit(kind).alias("type"), said.alias("description"), F.lit(how).alias("severity"), none.alias("start"), none.alias("end"), seen.alias("preview"))
    n_text, power, status, n_endpoints = value_at(card, "sample_size.total_n"), value_at(card, "sample_size.power").try_cast("double"), value_at(card, "trial.status"), F.size(_items(card, "primary_endpoints"))
    n = n_text.try_cast("double")
    return F.array_compact(
        F.array(
            F.when((n != 0) & (n < 100), row("sample_size", F.concat(F.lit("Small sample size (n="), n_text, F.lit(")")), "major", F.concat(F.lit("Total sample size: "), n_text))),
            F.when((power != 0) & (power < 0.8), row("sample_size", F.format_string("Underpowered study (power=%.2f)", power), "major", F.format_string("Statistical power: %.2f", power))),
            F.when(F.lower(status).contains("terminated"), row("follow_up", F.lit("Study terminated early"), "critical", F.concat(F.lit("Trial status: "), status))),
            F.when(n_endpoints > 3, row("endpoints", F.lit("Multiple primary endpoints may reduce statistical power"), "moderate", F.concat(F.lit("Number of primary endpoints: "), n_endpoints.cast("string")))),
        )
    )


def structural_oddities(card: Column) -> Column:
    """Structs (type, description, start, end, preview): primary p-values under 0.001, over 20 % of dropouts."""
    none = F.lit(None).cast("int")
    row = lambda kind, said, seen: F.struct(F.lit(kind).alias("type"), said.alias("description"), none.alias("start"), none.alias("end"), seen.alias("preview"))
    p_values = F.transform(_items(card, "results.primary"), lambda r: F.try_variant_get(r, "$.p_value", "string"))
    tiny = F.filter(p_values, lambda p: p.try_cast("double") < 0.001)
    lost = value_at(card, "populations.dropouts_overall_pct")
    dropout = F.when(lost.try_cast("double") > 20, row("clinical", F.concat(F.lit("High dropout rate ("), lost, F.lit("%)")), F.concat(F.lit("Overall dropout rate: "), lost, F.lit("%"))))
    said = lambda p: row("statistical", F.format_string("Extremely low p-value (p=%.6f)", p.try_cast("double")), F.concat(F.lit("Primary result p-value: "), p))
    return F.concat(F.transform(tiny, said), F.array_compact(F.array(dropout)))


def structural_discrepancies(card: Column) -> Column:
    """Structs (type, description, source1, source2, start, end, preview): another population than ITT, changes after the last patient."""
    none = F.lit(None).cast("int")

    def row(kind, said, one, two, seen):
        return F.struct(F.lit(kind).alias("type"), F.lit(said).alias("description"), one.alias("source1"), two.alias("source2"), none.alias("start"), none.alias("end"), seen.alias("preview"))

    on, results = value_at(card, "populations.analysis_primary_on"), F.try_variant_get(card, "$.results", "map<string,variant>")
    itt = F.when((on != "ITT") & (on != "") & results.isNotNull(), row("outcomes", "Primary analysis not on ITT population", F.lit("Protocol (ITT)"), F.concat(F.lit("Actual analysis ("), on, F.lit(")")), F.concat(F.lit("Primary analysis on: "), on)))
    late = F.filter(_items(card, "protocol_changes"), lambda c: ~F.coalesce(F.try_variant_get(c, "$.post_LPR", "string"), F.lit("false")).isin("false", "0", "", "[]", "{}"))
    change = lambda c: row("dates", "Protocol change after LPR", F.lit("Original protocol"), F.lit("Modified protocol"), F.concat(F.lit("Protocol change: "), F.coalesce(F.try_variant_get(c, "$.change", "string"), F.lit("Unknown"))))
    return F.concat(F.array_compact(F.array(itt)), F.transform(late, change))


def limitations(text: Column, card: Column | None = None, most: int = 20) -> Column:
    """Limitations the text names, then those of the card's structure; the first `most`, as a report shows them."""

    def row(kind, m):
        near = lambda c: F.struct(kind.alias("type"), m["value"].alias("description"), severity(kind, m["value"], c).alias("severity"), m["start"].alias("start"), m["end"].alias("end"), _strip(c).alias("preview"))
        return let(_around(text, m, 100), near)

    found = _matches(text, LIMITATIONS, row)
    return F.slice(found if card is None else F.concat(found, structural_limitations(card)), 1, most)


def oddities(text: Column, card: Column | None = None, most: int = 15) -> Column:
    """Oddities the text names, then those of the card's structure; the first `most`."""
    row = lambda kind, m: F.struct(kind.alias("type"), m["value"].alias("description"), m["start"].alias("start"), m["end"].alias("end"), _strip(_around(text, m, 100)).alias("preview"))
    found = _matches(text, ODDITIES, row)
    return F.slice(found if card is None else F.concat(found, structural_oddities(card)), 1, most)


def region_outliers(text: Column, least: int = 4, most: int = 10) -> Column:
    """Structs (region, impact, start, end, preview) of mentions of regions whose name stands `least` times or more in the
    text, as a word or within one; the first `most`."""
    t = F.lower(F.coalesce(text, F.lit("")))

    def often(m):
        name = F.lower(m["value"])
        return (F.length(t) - F.length(F.replace(t, name))) >= least * F.length(name)

    def row(m):
        return let(_around(text, m, 150), lambda c: F.struct(m["value"].alias("region"), region_impact(c).alias("impact"), m["start"].alias("start"), m["end"].alias("end"), _strip(c).alias("preview")))

    found = F.flatten(F.transform(F.array(*map(F.lit, REGIONS)), lambda p: spans(text, p)))
    return F.slice(F.transform(F.filter(found, often), row), 1, most)


def discrepancies(text: Column, card: Column | None = None, most: int = 15) -> Column:
    """Discrepancies the text names, then those of the card's structure; the first `most`."""

    def row(kind, m):
        def near(c):
            pair = sources(kind, c)
            return F.struct(kind.alias("type"), m["value"].alias("description"), pair["source1"].alias("source1"), pair["source2"].alias("source2"), m["start"].alias("start"), m["end"].alias("end"), _strip(c).alias("preview"))

        return let(_around(text, m, 150), near)

    found = _matches(text, DISCREPANCIES, row)
    return F.slice(found if card is None else F.concat(found, structural_discrepancies(card)), 1, most)
