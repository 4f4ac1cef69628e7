"""Pieces of the oracle statements."""

from __future__ import annotations

from lodestar.functions.stats import INV_C, INV_D, PHI_B, PHI_C, PHI_P
from lodestar.plans.adapters import CARDS, TRIALS, VERSIONS


def e(x: float) -> str:
    """A double literal (plain decimals are DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


def phi(x: str) -> str:
    t = f"(1e0 / (1e0 + {e(PHI_P)} * abs({x})))"
    poly = "0e0"
    for b in reversed(PHI_B):
        poly = f"{t} * ({poly} + {e(b)})"
    tail = f"{e(PHI_C)} * exp(-({x}) * ({x}) / 2e0) * {poly}"
    return f"(CASE WHEN ({x}) < -8 THEN 0e0 WHEN ({x}) > 8 THEN 1e0 WHEN ({x}) >= 0 THEN 1e0 - {tail} ELSE {tail} END)"


def z(a: str) -> str:
    def upper(p: str) -> str:
        t = f"sqrt(-2e0 * ln({p}))"
        return f"({t} - ({e(INV_C[0])} + {e(INV_C[1])} * {t} + {e(INV_C[2])} * {t} * {t}) / (1e0 + {e(INV_D[0])} * {t} + {e(INV_D[1])} * {t} * {t} + {e(INV_D[2])} * {t} * {t} * {t}))"

    return f"(CASE WHEN {a} = 25e-3 THEN {e(1.96)} WHEN {a} = 5e-2 THEN {e(1.645)} WHEN {a} = 1e-2 THEN {e(2.326)} WHEN {a} <= 5e-1 THEN {upper(a)} ELSE -{upper(f'(1e0 - {a})')} END)"


WITH_CARDS = f"WITH c AS ({CARDS})"

POWER = f"""
p1 AS (SELECT *, coalesce(p_c, hist_rate) AS pc, coalesce(delta, mcid, 12e-2) AS d, delta IS NULL AS low1,
    coalesce(alpha, CASE WHEN one_sided THEN 25e-3 ELSE 5e-2 END) / CASE WHEN one_sided THEN 1e0 ELSE 2e0 END AS a1,
    coalesce(alpha, 5e-2) / 2e0 AS a2, coalesce(planned_events, events_observed) AS ev0, n_t / CAST(n_c AS DOUBLE) AS k FROM c),
p2 AS (SELECT *, greatest(1e-9, least(1e0 - 1e-9, pc + d)) AS pt, coalesce(CAST(ev0 AS DOUBLE), floor(6e-1 * n_total)) AS ev FROM p1),
p3 AS (SELECT *, abs(d) / sqrt(pt * (1 - pt) / n_t + pc * (1 - pc) / n_c) - {z('a1')} AS x1, sqrt(ev * (k / ((1 + k) * (1 + k)))) * abs(ln(hr_alt)) - {z('a2')} AS x2 FROM p2),
p4 AS (SELECT *, CASE WHEN NOT is_pivotal THEN NULL WHEN primary_type = 'proportion' THEN {phi('x1')} WHEN primary_type = 'tte' THEN {phi('x2')} END AS pw,
    CASE WHEN primary_type = 'tte' THEN ev0 IS NULL ELSE low1 END AS low FROM p3),
s2 AS (SELECT trial_id, pw, coalesce(pw < CASE WHEN low THEN 55e-2 ELSE 7e-1 END, false) AS fired, CASE WHEN coalesce(pw < CASE WHEN low THEN 55e-2 ELSE 7e-1 END, false) THEN CASE WHEN pw < 55e-2 THEN 'H' ELSE 'M' END ELSE 'L' END AS severity, pw IS NOT NULL AND low AS low_cert FROM p4)"""

S3 = "(itt_p >= 5e-2 AND ((sg1_p < 5e-2 AND NOT sg1_adj AND NOT sg1_pre) OR (sg2_p < 5e-2 AND NOT sg2_adj)))"
GAP = "abs(drop_t - drop_c)"
S4 = f"((itt_p >= 5e-2 OR itt_est <= 0) AND pp_p IS NOT NULL AND pp_p < 5e-2 AND pp_est > 0 AND {GAP} >= 1e-1)"
S6A = "(interims >= 2 AND spending IS NULL)"
S6 = f"({S6A} OR (peeks > interims AND NOT realloc))"
S7 = "(is_pivotal AND single_arm)"
CUSP = "(itt_p >= 45e-3 AND itt_p <= 5e-2)"
S9 = "(pfs_hr IS NOT NULL AND (pfs_p < 5e-2 OR (pfs_hr < 1 AND pfs_ci < 1)) AND os_hr >= 11e-1 AND os_frac >= 6e-1 AND os_p < 2e-1 AND xover <= 3e-1)"

HEAPS = """heap AS (SELECT sponsor_id, count(*) FILTER (itt_p >= 45e-3 AND itt_p < 5e-2) AS l, count(*) FILTER (itt_p >= 5e-2 AND itt_p <= 55e-3) AS r FROM c GROUP BY 1),
tails AS (SELECT sponsor_id, l, r, l + r >= 10 AND l >= 2 * r AS heaped, (SELECT sum(exp(lgamma(l + r + 1) - lgamma(j + 1) - lgamma(l + r - j + 1) - (l + r) * ln(2e0))) FROM (SELECT unnest(range(l, l + r + 1)) AS j)) AS tail FROM heap)"""

CLASSES = """cls AS (SELECT class_id, quantile_cont(CASE WHEN itt_p < 5e-2 THEN effect END, 0.75) AS p75, quantile_cont(CASE WHEN itt_p < 5e-2 THEN effect END, 0.9) AS p90, count(*) FILTER (NOT itt_p < 5e-2) > 5e-1 * count(*) AS graveyard FROM c GROUP BY 1)"""

CONCEPT = """CASE WHEN t = '' THEN 'unknown' WHEN t LIKE '%overall survival%' OR t LIKE '%os%' THEN 'os' WHEN t LIKE '%progression-free%' OR t LIKE '%pfs%' THEN 'pfs' WHEN t LIKE '%objective response%' OR t LIKE '%orr%' THEN 'orr' WHEN t LIKE '%progression%' THEN 'pfs' WHEN t LIKE '%response%' THEN 'orr' ELSE 'other' END
 || '|' || CASE WHEN t = '' THEN 'unspecified' WHEN t LIKE '%12 month%' OR t LIKE '%12-month%' OR t LIKE '%12m%' THEN '12m' WHEN t LIKE '%24%' THEN '24m' WHEN t LIKE '%6%' THEN '6m' ELSE 'unspecified' END
 || '|' || CASE WHEN t = '' THEN 'unknown' WHEN t LIKE '%non-inferior%' OR t LIKE '%noninferior%' OR t LIKE '%ni%' THEN 'ni' WHEN t LIKE '%superior%' THEN 'si' ELSE 'unknown' END
 || '|' || CASE WHEN t = '' THEN 'unknown' WHEN t LIKE '%open-label%' OR t LIKE '%open label%' THEN 'open' WHEN t LIKE '%blind%' THEN 'blinded' ELSE 'unknown' END"""

S1 = f"""v AS ({VERSIONS}), v1 AS (SELECT *, lower(coalesce(endpoint, '')) AS t FROM v), v2 AS (SELECT *, {CONCEPT} AS concept FROM v1),
v3 AS (SELECT *, lag(concept) OVER w AS was FROM v2 WINDOW w AS (PARTITION BY trial_id ORDER BY captured_at, version_id)),
s1 AS (SELECT trial_id, count(*) AS n_versions, bool_or(coalesce(was <> concept AND date_diff('day', CAST(captured_at AS DATE), completion) <= 180, false)) AS fired FROM v3 GROUP BY 1)"""

SIGNALS = f"""{POWER}, {HEAPS}, {CLASSES}, {S1},
sig AS (SELECT c.*, coalesce(s1.fired, false) AS f1, s2.fired AS f2, {S3} AS f3, {S4} AS f4, coalesce(cls.graveyard AND effect >= cls.p75, false) AS f5, {S6} AS f6, {S7} AS f7, {CUSP} OR coalesce(tails.heaped AND tails.tail < 1e-2, false) AS f8, {S9} AS f9,
  CASE WHEN s1.fired THEN 'H' ELSE 'L' END AS v1, s2.severity AS v2
  FROM c LEFT JOIN s1 USING (trial_id) JOIN s2 USING (trial_id) LEFT JOIN cls USING (class_id) LEFT JOIN tails USING (sponsor_id))"""

GATES = """gat AS (SELECT *, f1 AND f2 AS g1, f3 AND f4 AS g2, f5 AND (f7 OR f6) AS g3, f8 AND (f1 OR f3) AS g4 FROM sig)"""

LOGS = f"(CASE WHEN g1 THEN ln({e(3.5)}) ELSE 0e0 END + CASE WHEN g2 THEN ln(3e0) ELSE 0e0 END + CASE WHEN g3 THEN ln({e(4.2)}) ELSE 0e0 END + CASE WHEN g4 THEN ln({e(2.5)}) ELSE 0e0 END)"

SCORES = f"""t AS ({TRIALS}),
pri AS (SELECT gat.*, t.phase, t.indication, t.company_id, t.completion, t.amount, t.status, t.is_pivotal AS pivotal_trial,
  greatest(1e-2, least(5e-1, 15e-2 * CASE WHEN t.is_pivotal THEN 12e-1 ELSE 8e-1 END * CASE WHEN indication LIKE '%oncology%' THEN 11e-1 WHEN indication LIKE '%rare_disease%' THEN 9e-1 ELSE 1e0 END * CASE WHEN phase LIKE '%phase_3%' THEN 11e-1 WHEN phase LIKE '%phase_1%' THEN 8e-1 ELSE 1e0 END)) AS prior_pi,
  {LOGS} AS sum_log_lr FROM gat JOIN t USING (trial_id)),
sco AS (SELECT *, greatest(-8e0, least(8e0, ln(prior_pi / (1 - prior_pi)) + sum_log_lr)) AS logit_post FROM pri),
scored AS (SELECT *, 1 / (1 + exp(-logit_post)) AS p_fail FROM sco)"""
