"""Normal distribution, power and binomial tails as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five-term polynomial for the normal distribution (Abramowitz and Stegun 26.2.17).
PHI_B = (0.31938153, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
PHI_P = 0.2316419
PHI_C = 0.39894228
# The rational approximation of its inverse (Abramowitz and Stegun 26.2.23).
INV_C = (2.515517, 0.802853, 0.010328)
INV_D = (1.432788, 0.189269, 0.001308)
# One-sided levels whose critical value comes from a table.
Z_TABLE = {0.025: 1.96, 0.05: 1.645, 0.01: 2.326}


def clamp(x: Column, low: float, high: float) -> Column:
    """x held between two bounds; null stays null (greatest and least would skip it)."""
    return F.when(x < low, F.lit(float(low))).when(x > high, F.lit(float(high))).otherwise(x)


def let(x: Column, use) -> Column:
    """use(x) with x computed once; nested formulas would otherwise repeat it at every mention."""
    return F.element_at(F.transform(F.array(x), use), 1)


def phi(x: Column) -> Column:
    """Standard normal distribution function; 0 and 1 beyond +-8."""
    return let(x, _phi)


def _phi(x: Column) -> Column:
    t = 1.0 / (1.0 + PHI_P * F.abs(x))
    poly = F.lit(0.0)
    for b in reversed(PHI_B):
        poly = t * (poly + b)
    tail = PHI_C * F.exp(-x * x / 2.0) * poly
    return F.when(x < -8.0, 0.0).when(x > 8.0, 1.0).when(x >= 0.0, 1.0 - tail).otherwise(tail)


def phi_inverse_upper(a: Column) -> Column:
    """The value that a standard normal exceeds with probability a."""

    def upper(tail: Column) -> Column:
        t = F.sqrt(-2.0 * F.log(tail))
        return t - (INV_C[0] + INV_C[1] * t + INV_C[2] * t * t) / (1.0 + INV_D[0] * t + INV_D[1] * t * t + INV_D[2] * t * t * t)

    return F.when(a <= 0.5, upper(a)).otherwise(-upper(1.0 - a))


def critical_z(alpha: Column, two_sided: Column) -> Column:

    def of(a: Column) -> Column:
        out = phi_inverse_upper(a)
        for level, z in Z_TABLE.items():
            out = F.when(a == level, F.lit(z)).otherwise(out)
        return out

    return let(F.when(two_sided, alpha / 2.0).otherwise(alpha), of)


def power_two_proportions(n_t: Column, n_c: Column, p_c: Column, delta: Column, alpha: Column, two_sided: Column) -> Column:
    """Power of a two-proportion test at an absolute difference."""
    p_t = clamp(p_c + delta, 1e-9, 1 - 1e-9)
    se = F.sqrt(p_t * (1 - p_t) / n_t + p_c * (1 - p_c) / n_c)
    return F.when(se == 0, 0.0).otherwise(phi(F.try_divide(F.abs(delta), se) - critical_z(alpha, two_sided)))


def power_logrank(events: Column, hazard_ratio: Column, allocation: Column, alpha: Column, two_sided: Column) -> Column:
    """Power of a log-rank test; 0 without events or with a hazard ratio that isn't positive."""
    psi = allocation / ((1 + allocation) * (1 + allocation))
    z = F.sqrt(events * psi) * F.abs(F.log(F.when(hazard_ratio > 0, hazard_ratio))) - critical_z(alpha, two_sided)
    return F.when(events.isNull() | (events <= 0) | (hazard_ratio <= 0), 0.0).otherwise(phi(z))


def binomial_upper_tail(k: Column, n: Column) -> Column:
    """P(X >= k) for n fair coins, summed by the ratio of neighbouring terms from n heads down."""
    step = F.aggregate(
        F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
        F.struct(F.pow(F.lit(0.5), n.cast("double")).alias("term"), F.lit(0.0).alias("total")),
        lambda a, j: F.struct((a["term"] * (n - j) / (j + 1)).alias("term"), (a["total"] + a["term"]).alias("total")),
        lambda a: a["total"],
    )
    return F.when(k > n, 0.0).otherwise(step)


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def logistic(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))
