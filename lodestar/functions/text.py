"""Names, tokens, trigrams and wording as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings that say what kind of company it is.
LEGAL_TAILS = ("inc", "inc.", "incorporated", "corp", "corp.", "corporation", "co", "co.", "company", "companies", "ltd", "ltd.", "limited", "llc", "l.l.c", "llp", "l.l.p", "lp", "l.p", "plc", "plc.", "holding", "holdings", "ag", "nv", "sa", "s.a", "spa", "s.p.a", "gmbh", "oyj", "ab", "publ", "kabushiki", "kaisha")
# Words of academic sponsors.
ACADEMIC = ("university", "hospital", "institute", "foundation", "college", "medical", "clinic", "centre", "center", "health", "system", "nhs", "trust", "school")
# Words that don't count in an acronym.
ACRONYM_STOP = ("the", "and", "&", "of", "for", "at", "to", "in")
# Tokens too common in company names to be strong.
WEAK_TOKENS = ("bio", "biosciences", "biotech", "pharma", "pharmaceutical", "pharmaceuticals", "therapeutic", "therapeutics", "inc", "corp", "ltd", "plc", "llc", "company", "holding", "holdings")


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility form (NFKD) has one ASCII character, and those up to U+218F or among the Latin
    ligatures where it has several."""
    one, many = {}, {}
    for c in map(chr, range(0x80, 0x10000)):
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one[c] = plain
        elif plain and (c < "\u2190" or "\ufb00" <= c <= "\ufb06"):
            many[c] = plain
    return one, many


_ONE, _MANY = _folds()


def ascii_fold(s: Column) -> Column:
    """The ASCII part of the compatibility form: accents off, ligatures and wide letters spelled out, all else beyond
    ASCII dropped."""
    table = F.create_map(*(F.lit(x) for pair in _MANY.items() for x in pair))
    # split cuts characters beyond the first plane in two; they have no ASCII part in any case
    plane = F.regexp_replace(s, r"[^\x{0}-\x{FFFF}]", "")
    each = F.array_join(F.transform(F.split(plane, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    spelled = F.when(s.rlike(f"[{''.join(_MANY)}]"), each).otherwise(s)
    return F.regexp_replace(F.translate(spelled, "".join(_ONE), "".join(_ONE.values())), r"[^\x00-\x7F]", "")


def norm_name(s: Column) -> Column:
    """Lower case ASCII, punctuation but hyphens made blanks; null: empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(ascii_fold(F.coalesce(s, F.lit("")))), r"[^\w\-]+", " "), r"\s+", " "))


def norm_loose(s: Column) -> Column:
    """As norm_name, without the word `and`."""
    return F.trim(F.regexp_replace(F.regexp_replace(norm_name(s), r"\band\b", " "), r"\s+", " "))


def tokens(s: Column) -> Column:
    """Words of a name with their hyphens, so that codes stay whole."""
    return F.regexp_extract_all(norm_name(s), F.lit(r"([A-Za-z0-9][A-Za-z0-9\-]*)"), 1)


def strip_legal(s: Column) -> Column:
    """Company endings off the end of a normalised name, as many as there are."""
    tail = "|".join(t.replace(".", r"\.") for t in LEGAL_TAILS)
    return F.trim(F.regexp_replace(F.concat(F.lit(" "), norm_name(s)), f"( ({tail}))+$", ""))


def acronym(s: Column) -> Column:
    stop = F.array(*(F.lit(w) for w in ACRONYM_STOP + LEGAL_TAILS + ACADEMIC))
    heads = F.filter(F.transform(tokens(s), lambda t: F.substring_index(t, "-", 1)), lambda b: (b != "") & ~F.array_contains(stop, b))
    return F.upper(F.array_join(F.transform(heads, lambda b: F.substring(b, 1, 1)), ""))


def is_academic(s: Column) -> Column:
    return (F.concat(F.lit(" "), norm_name(s), F.lit(" "))).rlike(f" ({'|'.join(ACADEMIC)}) ")


def dice(a: Column, b: Column) -> Column:
    """Twice the common over the sum of two token sets; 0 if either is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def strong_tokens(s: Column) -> Column:
    weak = F.array(*(F.lit(w) for w in WEAK_TOKENS))
    return F.filter(tokens(s), lambda t: (F.length(t) >= 6) & ~F.array_contains(weak, t))


def trigrams(s: Column) -> Column:
    """Distinct trigrams of each word, padded by two blanks before and one after."""
    words = F.filter(F.split(F.lower(s), "[^a-z0-9]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))))


def domains(s: Column) -> Column:
    """Host names in a text, lower case, without www., first occurrence first."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(s), F.lit(r"\b((?:[a-z0-9-]+\.)+[a-z]{2,})\b"), 1), lambda d: F.regexp_replace(d, r"^www\.", "")))


def endpoint_concept(s: Column) -> Column:
    """Class, time point, non-inferiority and blinding of an endpoint's wording.

    Plain substring tests, in order, so `dose` holds `os`: that is the rule, not an accident here.
    """
    t = F.lower(F.coalesce(s, F.lit("")))
    has = lambda *xs: _any(t, xs)
    kind = F.when(t == "", "unknown").when(has("overall survival", "os"), "os").when(has("progression-free", "pfs"), "pfs").when(has("objective response", "orr"), "orr").when(has("progression"), "pfs").when(has("response"), "orr").otherwise("other")
    point = F.when(t == "", "unspecified").when(has("12 month", "12-month", "12m"), "12m").when(has("24"), "24m").when(has("6"), "6m").otherwise("unspecified")
    margin = F.when(t == "", "unknown").when(has("non-inferior", "noninferior", "ni"), "ni").when(has("superior"), "si").otherwise("unknown")
    blind = F.when(t == "", "unknown").when(has("open-label", "open label"), "open").when(has("blind"), "blinded").otherwise("unknown")
    return F.struct(kind.alias("class"), point.alias("timepoint"), margin.alias("ni"), blind.alias("blinded"))


def _any(t: Column, words: tuple[str, ...]) -> Column:
    out = t.contains(words[0])
    for w in words[1:]:
        out = out | t.contains(w)
    return out


def count_matches(s: Column, patterns: tuple[str, ...]) -> Column:
    """How often any of the patterns occurs, ignoring case."""
    out = F.lit(0)
    for p in patterns:
        out = out + F.regexp_count(F.coalesce(s, F.lit("")), F.lit(f"(?i){p}"))
    return out
