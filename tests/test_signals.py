"""Signals, gates and scores against hand-worked values and a scalar version."""

import math

import pytest
from pyspark.sql import functions as F

from lodestar.functions import stats
from lodestar.operators import calibration, catalyst, gates, scoring, signals

CARD = """is_pivotal boolean, primary_type string, single_arm boolean, historical_control_rate double, mcid_abs double, events_observed int, N_total int, actual_peeks int,
narrative_highlights_subgroup boolean, endpoint_subjective_unblinded boolean, arms struct<t:struct<n:int,dropout:double>,c:struct<n:int,dropout:double>>,
analysis_plan struct<alpha:double,one_sided:boolean,two_sided:boolean,assumed_p_c:double,assumed_delta_abs:double,hr_alt:double,planned_events:int,alloc_ratio:double,planned_interims:int,alpha_spending:string,reallocated_alpha:boolean>,
primary_result struct<ITT:struct<p:double,estimate:double>,PP:struct<p:double,estimate:double>,effect_size:double>,
subgroups array<struct<name:string,p:double,adjusted:boolean,pre_specified_interaction:boolean>>, pfs struct<hr:double,p:double,ci95_upper:double>, os struct<hr:double,p:double,events_frac:double,crossover_rate:double>"""


def evaluate(spark, column, *cards):
    """The signal of each card, given as a JSON-like dict (what is missing is null)."""
    import json

    rows = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cards)], "id int, j string")
    schema = "struct<" + ",".join(x for x in _fields()) + ">"
    out = rows.select("id", F.from_json("j", schema).alias("card")).select("id", column(F.col("card")).alias("s")).orderBy("id").collect()
    return [r["s"] for r in out]


def _fields():
    depth, start = 0, 0
    for i, ch in enumerate(CARD):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            yield CARD[start:i].strip().replace(" ", ":", 1)
            start = i + 1
    yield CARD[start:].strip().replace(" ", ":", 1)


def itt(p, **k):
    return {"primary_result": {"ITT": {"p": p, **k}}}


def test_normal_distribution_and_inverse(spark):
    xs = [-9.0, -3.0, -1.0, 0.0, 0.5, 1.96, 9.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(stats.phi(F.col("x")).alias("p")).collect()
    for x, r in zip(xs, got, strict=True):
        assert r["p"] == pytest.approx(0.5 * math.erfc(-x / math.sqrt(2)), abs=2e-7)
    z = spark.createDataFrame([(0.05, True), (0.05, False), (0.025, False), (0.2, False)], "a double, t boolean").select(stats.critical_z(F.col("a"), F.col("t")).alias("z")).collect()
    assert [r["z"] for r in z[:3]] == [1.96, 1.645, 1.96] and z[3]["z"] == pytest.approx(0.8416, abs=1e-3)


@pytest.mark.parametrize(("k", "n", "want"), [(9, 10, 11 / 1024), (10, 10, 1 / 1024), (0, 5, 1.0), (6, 5, 0.0), (60, 100, 0.02844396682)])
def test_binomial_tail(spark, k, n, want):
    got = spark.range(1).select(stats.binomial_upper_tail(F.lit(k), F.lit(n)).alias("p")).first()["p"]
    assert got == pytest.approx(want, rel=1e-9)


def test_s2_defaults_and_branches(spark):
    base = {"is_pivotal": True, "primary_type": "proportion", "arms": {"t": {"n": 50}, "c": {"n": 50}}, "analysis_plan": {"assumed_p_c": 0.5, "assumed_delta_abs": 0.01}}
    low, no_delta, not_pivotal, tte, no_ratio = evaluate(
        spark, signals.s2, base,
        {**base, "analysis_plan": {"assumed_p_c": 0.3}},
        {**base, "is_pivotal": False},
        {"is_pivotal": True, "primary_type": "tte", "N_total": 500, "analysis_plan": {"hr_alt": 0.6}},
        {"is_pivotal": True, "primary_type": "tte", "analysis_plan": {"planned_events": 10}},
    )
    assert low.fired and low.severity == "H" and not low.low_cert
    assert no_delta.low_cert and no_delta.fired and not not_pivotal.fired
    assert tte.low_cert and not tte.fired and tte.value > 0.9
    assert not no_ratio.fired and no_ratio.value is None


def test_s3_needs_an_unplanned_win(spark):
    win = {"name": "young", "p": 0.01}
    a, b, c, d = evaluate(spark, signals.s3, {**itt(0.2), "subgroups": [win, {"p": 0.02}]}, {**itt(0.04), "subgroups": [win]}, {**itt(0.2), "subgroups": [{**win, "adjusted": True}]}, {"subgroups": [win], "narrative_highlights_subgroup": True})
    assert a.fired and a.severity == "M" and "young, unnamed" in a.reason
    assert not b.fired and not c.fired and d.fired and d.severity == "H"


def test_s4_boundaries(spark):
    def card(t, c, **k):
        return {"primary_result": {"ITT": {"p": 0.2, "estimate": 0.1}, "PP": {"p": 0.01, "estimate": 0.2}}, "arms": {"t": {"dropout": t}, "c": {"dropout": c}}, **k}

    ten, more, none, less = evaluate(spark, signals.s4, card(0.25, 0.125), card(0.25, 0.0), {**card(0.5, 0.0), "primary_result": {"ITT": {"p": 0.2}}}, card(0.1, 0.05))
    assert ten.fired and ten.severity == "M" and more.severity == "H" and not none.fired and not less.fired


@pytest.mark.parametrize(("p", "fired"), [(0.044, False), (0.045, True), (0.049, True), (0.050, True), (0.051, False), (-0.1, False), (1.1, False)])
def test_s8_cusp_is_closed(spark, p, fired):
    assert evaluate(spark, signals.s8, itt(p))[0].fired == fired


def test_s8_heaping(spark):
    rows = spark.createDataFrame([(9, 0), (9, 1), (10, 0), (10, 5)], "l int, r int").select(signals.s8(F.from_json(F.lit("{}"), "primary_result struct<ITT:struct<p:double>>"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s.fired for r in rows] == [False, False, True, False] and rows[2].s.severity == "H"


def test_s6_s7_s9(spark):
    six = evaluate(spark, signals.s6, {"analysis_plan": {"planned_interims": 2}}, {"analysis_plan": {"planned_interims": 2, "alpha_spending": "obf"}}, {"actual_peeks": 1}, {"actual_peeks": 1, "analysis_plan": {"reallocated_alpha": True}})
    assert [(s.fired, s.severity) for s in six] == [(True, "H"), (False, "L"), (True, "M"), (False, "L")]
    seven = evaluate(spark, signals.s7, {"is_pivotal": True, "single_arm": True}, {"single_arm": True}, {"is_pivotal": True})
    assert [s.fired for s in seven] == [True, False, False]
    os = {"hr": 1.2, "p": 0.1, "events_frac": 0.6, "crossover_rate": 0.3}
    nine = evaluate(spark, signals.s9, {"pfs": {"p": 0.01}, "os": os}, {"pfs": {"p": 0.01}, "os": {**os, "hr": 1.1}}, {"pfs": {"p": 0.2, "hr": 0.9, "ci95_upper": 0.99}, "os": {**os, "crossover_rate": 0.31}}, {"os": os})
    assert [(s.fired, s.severity) for s in nine] == [(True, "H"), (True, "M"), (False, "L"), (False, "L")]


def test_s1_substrings_and_days(spark):
    rows = [
        (1, 1, "2024-01-01", "Overall survival", "2024-06-29"), (1, 2, "2024-01-01", "Response rate", "2024-06-29"),
        (2, 1, "2024-01-01", "Overall survival", "2025-01-01"), (2, 2, "2024-01-02", "Response rate", "2025-01-01"),
        (3, 1, "2024-01-01", "dose", "2024-01-05"), (3, 2, "2024-01-02", "Overall survival", "2024-01-05"), (4, 1, "2024-01-01", "x", None),
    ]
    v = spark.createDataFrame(rows, "trial_id int, version_id int, captured_at string, endpoint string, completion string")
    got = {r.trial_id: r for r in signals.s1(v).collect()}
    assert got[1].fired and got[1].evidence == ["1", "2"] and got[1].severity == "H"
    assert not got[2].fired and not got[3].fired and not got[4].fired


def _gated(spark):
    import itertools

    rows = [(i, *c) for i, c in enumerate(itertools.product([False, True], repeat=8))]
    df = spark.createDataFrame(rows, "trial_id int, " + ", ".join(f"{s} boolean" for s in ("a", "b", "c", "d", "e", "f", "g", "h")))
    names = dict(zip(("S1", "S2", "S3", "S4", "S5", "S6", "S7", "S8"), "abcdefgh", strict=True))
    return gates.evaluate(df.select("*", *(F.struct(F.col(c).alias("fired"), F.lit("M").alias("severity")).alias(s) for s, c in names.items())))


def test_gate_truth_table(spark):
    for r in _gated(spark).collect():
        assert r.G1.fired == (r.a and r.b) and r.G2.fired == (r.c and r.d)
        assert r.G3.fired == (r.e and (r.f or r.g)) and r.G4.fired == (r.h and (r.a or r.c))
        assert r.G1.lr == (3.5 if r.G1.fired else 1.0) and r.G3.lr == (4.2 if r.G3.fired else 1.0)


def test_posterior_and_stop_rules(spark):
    g = _gated(spark)
    plain = {r.trial_id: r for r in scoring.score(g, F.lit(True), F.lit("Oncology"), F.lit("PHASE_3")).collect()}
    stopped = {r.trial_id: r for r in scoring.score(g, F.lit(True), F.lit("Oncology"), F.lit("PHASE_3"), (F.lit(True), F.lit(False), F.lit(False))).collect()}
    prior = 0.15 * 1.2 * 1.1 * 1.1
    for k, r in plain.items():
        z = math.log(prior / (1 - prior)) + sum(math.log(r[x].lr) for x in gates.GATES if r[x].fired)
        assert r.p_fail == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-12)
        assert stopped[k].p_fail == (max(0.97, r.p_fail) if r.a else r.p_fail) >= r.p_fail


def test_calibration_needs_ten_and_shrinks(spark):
    rows = [("G1", "H", i < 3) for i in range(10)] + [("G2", "H", True)] * 9 + [("G3", "M", False)] * 12
    got = {(r.gate, r.severity): r.lr for r in calibration.gate_ratios(spark.createDataFrame(rows, "gate string, severity string, failed boolean")).collect()}
    assert got == {("G1", "H"): 1.9, ("G3", "M"): 1.0}


def test_auc_with_ties(spark):
    rows = [(0.1, False), (0.4, True), (0.4, False), (0.8, True), (0.8, True), (0.2, False)]
    got = calibration.auc(spark.createDataFrame(rows, "s double, y boolean"), F.col("s"), F.col("y")).first()["auc"]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    assert got == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 9)


def test_windows_fuse(spark):
    rows = [(1, [("2025-01-01", "2025-01-31", 0.4), ("2025-01-20", "2025-02-10", 0.9)]), (2, [("2025-01-01", "2025-01-10", 0.4), ("2025-03-01", "2025-03-02", 0.9)]), (3, [("2025-01-01", "2025-01-16", 0.5)])]
    df = spark.createDataFrame(rows, "id int, w array<struct<start:string,end:string,weight:double>>")
    cast = F.transform("w", lambda x: F.struct(x["start"].cast("date").alias("start"), x["end"].cast("date").alias("end"), x["weight"].alias("weight")))
    got = {r.id: r.f for r in df.select("id", catalyst.fuse(cast).alias("f")).collect()}
    assert str(got[1].window_start) == "2025-01-20" and got[1].certainty == pytest.approx(1 - 11 / 30 * 0.1)
    assert str(got[2].window_end) == "2025-03-02" and got[2].certainty == pytest.approx(1 - 60 / 45 * 0.1)
    assert got[3].certainty == pytest.approx(1 - 15 / 30 * 0.5)


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_numbering_keeps_rows_with_a_payload(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(200_000).select((F.xxhash64("id") % 1000).alias("k"), F.col("id"), F.concat(F.lit("payload "), F.col("id").cast("string")).alias("text"))
        got = catalyst.number_rows(df, [F.desc("k"), F.asc("id")])
        n = got.agg(F.count("*"), F.countDistinct("position"), F.min("position"), F.max("position")).first()
        assert tuple(n) == (200_000, 200_000, 1, 200_000)
        want = [r.text for r in df.orderBy(F.desc("k"), "id").limit(50).collect()]
        assert [r.text for r in got.where("position <= 50").orderBy("position").collect()] == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_global_numbering(spark):
    df = spark.range(1000).withColumn("k", F.col("id") * 37 % 101)
    got = catalyst.number_rows(df, [F.desc("k"), F.asc("id")]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 1001)) and [(r.k, r.id) for r in got] == sorted(((r.k, r.id) for r in got), key=lambda x: (-x[0], x[1]))
