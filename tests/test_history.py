"""Listings against events taken one by one, names, running sums and the fit against plain versions."""

import datetime as dt
import random

import numpy as np
import pytest
from lodestar.operators import fit, gazetteer, running, securities
from pyspark.sql import functions as F

SCHEMA = "ticker string, seq long, kind string, company_id long, exchange string, date date, status string"
DAY = dt.date(2024, 1, 1)


def applied(events):
    """The tickers' rows after all events, taken one by one in the order of date and arrival."""
    state = {}
    seen = set()
    for t, _, kind, company, exchange, day, status in sorted(events, key=lambda e: (e[5], e[1])):
        rows = state.setdefault(t.upper(), [])
        for step in {"list": ("list",), "close": ("close",), "transfer": ("close", "list")}[kind]:
            said = (t.upper(), day, step, *((company, exchange) if step == "list" else (status,)))
            if said in seen:
                continue
            seen.add(said)
            if step == "close":
                for r in [r for r in rows if r[3] is None and r[2] < day]:
                    r[3], r[4] = day, status or "delisted"
                    rows.append([r[0], r[1], day, day, r[4]])
            else:
                for r in [r for r in rows if r[3] is None]:
                    r[3], r[4] = day, "delisted"
                rows.append([company, exchange, day, None, "active"])
    return sorted(((t, *r) for t, rows in state.items() for r in rows), key=str)


def random_events(seed, n=400):
    r = random.Random(seed)
    out = []
    for k in range(n):
        out.append((r.choice("abcdeABCDE"), k, r.choice(("list", "list", "close", "transfer")), r.randint(1, 3), r.choice(("NYSE", "NASDAQ")), DAY + dt.timedelta(r.randint(0, 25)), r.choice((None, "suspended"))))
    return out


def state_of(spark, events):
    rows = securities.timeline(spark.createDataFrame(events, SCHEMA).repartition(3)).collect()
    return sorted(((r["ticker"], r["company_id"], r["exchange"], r["valid_from"], r["valid_to"], r["status"]) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_timeline_equals_events_taken_one_by_one(spark, seed):
    events = random_events(seed)
    want = applied(events)
    assert state_of(spark, events) == want
    random.Random(seed).shuffle(events)  # late rows fall into place
    assert state_of(spark, events) == want
    again = [(t, 1000 + s, *rest) for t, s, *rest in events[:150]]  # a part of the log applied once more
    assert state_of(spark, events + again) == want


def test_two_closings_and_one_before_the_listing(spark):
    day = lambda n: DAY + dt.timedelta(n)
    events = [("x", 1, "list", 1, "NYSE", day(10), None), ("x", 2, "close", None, None, day(5), None), ("x", 3, "close", None, None, day(20), None), ("x", 4, "close", None, None, day(30), None), (None, 5, "list", 1, "NYSE", day(1), None), ("y", 6, "list", 1, "NYSE", None, None), ("z", 7, "what", 1, "NYSE", day(1), None)]
    rows = [(r["ticker"], r["valid_from"], r["valid_to"], r["marker"]) for r in securities.timeline(spark.createDataFrame(events, SCHEMA)).orderBy("valid_from").collect()]
    assert rows == [("X", day(10), day(20), False), ("X", day(20), day(20), True)]
    held = securities.timeline(spark.createDataFrame(random_events(3), SCHEMA))
    per = securities.listed_on(held, F.lit(day(12))).groupBy("ticker").count().collect()
    assert per and all(r["count"] == 1 for r in per)


def test_only_allowed_exchanges_are_admitted(spark):
    events = spark.createDataFrame([("a", 1, "list", 1, "PINK", DAY, None), ("a", 2, "close", 1, None, DAY, None), ("b", 3, "transfer", 1, "NYSE", DAY, None), ("c", 4, "list", 1, None, DAY, None)], SCHEMA)
    on = spark.createDataFrame([("NYSE", True), ("PINK", False), ("NYSE", False)], "code string, is_allowed boolean")
    assert {r["seq"]: r["admitted"] for r in securities.admitted(events, on).collect()} == {1: False, 2: True, 3: True, 4: False}


def test_registrants_again_add_nothing(spark):
    rows = spark.createDataFrame([(1, 10, "Acme, Inc.", "A", "Nasdaq"), (2, 10, "Acme Corp", "AB", "NYSE"), (3, 11, "Beta", "B", "Pink"), (4, 12, "Gamma", "G", "OTCQX"), (5, None, "No", "N", "NYSE")], "row_no long, cik long, title string, ticker string, exchange string")
    on = spark.createDataFrame([("NASDAQ", True), ("NYSE", True)], "code string, is_allowed boolean")
    none = spark.createDataFrame([(7, 99, "Old")], "company_id long, cik long, name string")
    no_names = spark.createDataFrame([], "company_id long, alias string, alias_norm string, alias_type string")
    start = F.lit(DAY)
    one = securities.ingest_registrants(rows, none, no_names, on, start)
    assert {tuple(r) for r in one["companies"].collect()} == {(7, 99, "Old"), (8, 10, "Acme Corp"), (9, 12, "Gamma")}
    assert {(r["company_id"], r["alias_norm"]) for r in one["aliases"].collect()} == {(8, "acme inc"), (8, "acme corp"), (9, "gamma")}
    assert tuple(one["counts"].first()) == (2, 1, 2, 3)
    two = securities.ingest_registrants(rows, one["companies"], one["aliases"], on, start)
    assert two["aliases"].count() == 0 and two["counts"].first()["inserted_companies"] == 0
    assert {tuple(r) for r in two["companies"].collect()} == {tuple(r) for r in one["companies"].collect()}


# names --------------------------------------------------------------------------------------------


def test_names_overlap_and_keep_their_places(spark):
    texts = [(1, "aspirin and ASPIRINaspirin"), (2, None), (3, ""), (4, "İaspirin É é aaaa"), (1, "aspirin and ASPIRINaspirin"), (5, "b" * 400_000 + "aaaa")]
    names = [("aspirin", "inn"), ("pirin", "part"), ("aa", "x"), ("é", "y"), ("", "none"), (None, "none"), ("aa", "a")]
    types = {"aspirin": "inn", "pirin": "part", "aa": "a", "é": "y"}
    want = sorted((i, n, types[n], k, k + len(n), t[k : k + len(n)]) for i, t in texts if t for low in ["".join(c.lower() if len(c.lower()) == 1 else c for c in t)] for n in types for k in range(len(t)) if low.startswith(n, k))
    t = spark.createDataFrame(texts, "id long, body string").withColumn("name", F.lit("clash"))
    n = spark.createDataFrame(names, "name string, name_type string")
    assert sorted(tuple(r) for r in gazetteer.find_names(t, n, "id", "body").collect()) == want
    assert sorted(tuple(r) for r in gazetteer.find_names(t, n, "id", "body", most_bytes=8).collect()) == want
    assert gazetteer.find_names(t, n.limit(0), "id", "body").collect() == []
    assert gazetteer.find_names(t.limit(0), n, "id", "body").collect() == []


def test_a_hundred_thousand_names(spark):
    names = spark.range(100_000).select(F.concat(F.lit("drug"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("x")).alias("name"), F.lit("code").alias("name_type"))
    texts = spark.range(50).select("id", F.concat(F.lit("Of DRUG"), F.lpad((F.col("id") * 1999).cast("string"), 6, "0"), F.lit("X it is.")).alias("body"))
    got = gazetteer.find_names(texts, names, "id", "body", most_bytes=400_000).collect()
    assert {(r["id"], r["start"], r["found"]) for r in got} == {(i, 3, f"DRUG{i * 1999:06d}X") for i in range(50)}


# running sums -------------------------------------------------------------------------------------


def test_running_sums_of_one_hot_key(spark):
    df = spark.range(20_000).select((F.col("id") % 10 == 0).alias("k"), (F.col("id") * 7919 % 20_011).alias("o"), F.when(F.col("id") % 3 != 0, F.col("id") % 5).alias("v"), F.lit("x").alias("_range"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running.running_sums(df.drop("_range"), ["k"], [F.col("o")], {"s": F.col("v"), "n": F.lit(1)}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for k in (False, True):
        rows = sorted((r["o"], r["v"] or 0, r["s"], r["n"]) for r in got if r["k"] is k)
        assert [r[2] for r in rows] == list(np.cumsum([r[1] for r in rows])) and [r[3] for r in rows] == list(range(1, len(rows) + 1))


def test_quantiles_equal_the_built_in_ones(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 501) / 3).alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, None), (8, 4.0)], "k long, v double"))
    want = {r["k"]: (r["a"], r["b"]) for r in df.where("v is not null and k is not null").groupBy("k").agg(F.percentile("v", 0.75).alias("a"), F.percentile("v", 0.1).alias("b")).collect()}
    got = {r["k"]: (r["a"], r["b"]) for r in running.exact_quantiles(df.where("k is not null"), ["k"], F.col("v"), {"a": 0.75, "b": 0.1}).collect()}
    assert got == want
    assert running.exact_quantiles(df, [], F.col("v"), {"m": 0.5}).first()["m"] == df.agg(F.percentile("v", 0.5)).first()[0]


# the fit ------------------------------------------------------------------------------------------


def newton(x, y):
    """Penalised logistic regression by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (p - y) + ridge @ w)
    return w


@pytest.mark.parametrize("n", [900, 120])
def test_fit_gives_the_weights_and_a_precise_threshold(spark, n):
    r = np.random.default_rng(3)
    x = r.normal(size=(n, 2))
    y = (r.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 0.5)))).astype(int)
    rows = spark.createDataFrame([(i, float(a), float(b), int(c), f"g{i % 37}", 1.0) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))], "id long, f1 double, f2 double, y int, g string, score double")
    rows = rows.drop("score").unionByName(rows.limit(1).drop("score").withColumn("y", F.lit(None).cast("int")))
    model = fit.fit_resolver(rows, ["f1", "f2"], "y", "g")
    assert np.allclose([model.weights["f1"], model.weights["f2"], model.intercept], newton(x, y), atol=2e-3)
    assert model.method == ("isotonic" if n == 900 else "sigmoid")
    got = [(q["score"], q["y"]) for q in model.scored.collect()]
    assert len(got) == n and all(0 <= s <= 1 for s, _ in got)
    good = [t for t in sorted({s for s, _ in got}) if np.mean([c for s, c in got if s >= t]) >= 0.95]
    assert model.tau_accept == max(0.5, good[0] if good else 1.0) and model.review_low == max(0.6, model.tau_accept - 0.2)
    s, c = np.array(got).T
    assert np.corrcoef(s, c)[0, 1] > 0.4 and abs(s.mean() - c.mean()) < 0.05


def test_fit_wants_both_classes(spark):
    with pytest.raises(ValueError):
        fit.fit_resolver(spark.createDataFrame([(1.0, 1, "a"), (2.0, 1, "b")], "f double, y int, g string"), ["f"], "y", "g")
