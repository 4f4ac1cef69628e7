"""Gates: combinations of signals with likelihood ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# For each gate its base ratio and, if any, ratios by severity of the evidence.
GATES = {
    "G1": (3.5, {"high": 5.0, "medium": 3.5, "low": 2.0}),
    "G2": (3.0, {}),
    "G3": (4.2, {}),
    "G4": (2.5, {}),
}
#: Each gate needs its first signal and, of the second group, one (any) or all.
NEEDS = {"G1": ("S1", ("S2",)), "G2": ("S3", ("S4",)), "G3": ("S5", ("S7", "S6")), "G4": ("S8", ("S1", "S3"))}
SEVERITY_NAMES = {"H": "high", "M": "medium", "L": "low"}


def fired(signal: str) -> Column:
    return F.col(signal)["fired"]


def gate(name: str, use_severity: bool = False) -> Column:
    """Struct (fired, lr, supporting).  Without use_severity the base ratio holds; with it, the largest ratio
    for the severities of the signals that fired."""
    first, second = NEEDS[name]
    any_of = fired(second[0])
    for s in second[1:]:
        any_of = any_of | fired(s)
    hit = fired(first) & any_of
    base, by_severity = GATES[name]
    ratio = F.lit(base)
    if use_severity and by_severity:
        options = [F.when(fired(s), F.coalesce(*(F.when(F.col(s)["severity"] == k, F.lit(by_severity[v])) for k, v in SEVERITY_NAMES.items()))) for s in (first, *second)]
        ratio = F.coalesce(F.greatest(*options) if len(options) > 1 else options[0], ratio)
    support = F.array_compact(F.array(*(F.when(fired(s), F.lit(s)) for s in (first, *second))))
    return F.struct(hit.alias("fired"), F.when(hit, ratio).otherwise(1.0).alias("lr"), F.when(hit, support).otherwise(F.array().cast("array<string>")).alias("supporting"))


def evaluate(signals: DataFrame, use_severity: bool = False) -> DataFrame:
    """Adds G1 to G4 to a frame with S1 to S9; no shuffle."""
    return signals.select("*", *(gate(g, use_severity).alias(g) for g in GATES))


def ratio_product(names: tuple[str, ...] = tuple(GATES)) -> Column:
    """Product of the ratios of the gates that fired."""
    out = F.lit(1.0)
    for g in names:
        out = out * F.col(g)["lr"]
    return out


def legacy_severity(g: str) -> Column:
    """H only for a ratio over 5."""
    return F.when(F.col(g)["lr"] > 5.0, "H").otherwise("M")


def fired_only(gated: DataFrame, names: tuple[str, ...] = tuple(GATES)) -> DataFrame:
    """Long form of those of the named gates that fired."""
    rows = F.explode(F.array_compact(F.array(*(F.when(F.col(g)["fired"], F.struct(F.lit(g).alias("G_id"), F.col(g)["lr"].alias("lr"), F.col(g)["supporting"].alias("supporting"))) for g in names))))
    return gated.select("trial_id", rows.alias("r")).select("trial_id", "r.G_id", "r.lr", "r.supporting")
