"""Snapshots against a search for the last row, gaps against a calendar."""

import datetime as dt
import random

from lodestar.operators import backtests
from pyspark.sql import functions as F

DAY = dt.date(2024, 3, 1)


def at(n, hour=0):
    return dt.datetime.combine(DAY + dt.timedelta(n), dt.time(hour))


def test_snapshots_hold_the_last_row_by_then(spark):
    r = random.Random(1)
    rows = [(r.randint(1, 6), at(r.randint(-20, 40), r.randint(0, 23)), r.random()) for _ in range(90)] + [(1, None, 0.5), (None, at(1), 0.5), (2, at(3, 5), 0.1), (2, at(3, 5), 0.9)]
    df = spark.createDataFrame(rows, "trial_id long, captured_at timestamp, p double")
    for every in (1, 7):
        got = sorted((x["snapshot_date"], x["trial_id"], x["captured_at"], x["p"]) for x in backtests.snapshots(df, F.lit(DAY), F.lit(DAY + dt.timedelta(30)), every).collect())
        want = []
        for n in range(0, 31, every):
            for t in range(1, 7):
                if by := [(c, p) for i, c, p in rows if i == t and c and c.date() <= DAY + dt.timedelta(n)]:
                    want.append((DAY + dt.timedelta(n), t, *max(by)))
        assert got == sorted(want)


def test_precision_by_day_and_report(spark):
    states = spark.createDataFrame([(DAY, 1, 0.9), (DAY, 2, 0.8), (DAY, 3, None), (DAY + dt.timedelta(1), 1, 0.2)], "snapshot_date date, trial_id long, p double")
    outcomes = spark.createDataFrame([(1, False), (2, True)], "trial_id long, success boolean")
    found = backtests.precision_by_day(states, outcomes, F.col("p"), (1, 2, 3, 4))
    got = {(r["snapshot_date"], r["k"]): (r["precision"], r["recall"]) for r in found.collect()}
    assert got == {(DAY, 1): (1.0, 0.5), (DAY, 2): (0.5, 0.5), (DAY, 3): (2 / 3, 1.0), (DAY + dt.timedelta(1), 1): (1.0, 1.0)}
    one = backtests.report(states, found).first()
    assert (one["snapshots"], one["trials"], one["first_day"], one["last_day"], one["mean_recall"]) == (4, 3, DAY, DAY + dt.timedelta(1), 0.75)


def test_gaps_equal_a_calendar(spark):
    r = random.Random(2)
    rows = [(r.choice("abc"), DAY + dt.timedelta(r.randint(-5, 35)), r.random() < 0.7) for _ in range(40)] + [("never", DAY, False), ("before", DAY - dt.timedelta(9), True), (None, DAY, True)]
    found = backtests.missing_days(spark.createDataFrame(rows, "pipeline_name string, day date, success boolean"), F.lit(DAY), F.lit(DAY + dt.timedelta(29))).collect()
    got = sorted((x["pipeline_name"], x["first_day"] + dt.timedelta(i)) for x in found for i in range(x["days"]))
    done = {(p, d) for p, d, ok in rows if ok}
    assert got == sorted((p, DAY + dt.timedelta(n)) for p in ("a", "b", "c", "never", "before") for n in range(30) if (p, DAY + dt.timedelta(n)) not in done)
    assert all(x["last_day"] == x["first_day"] + dt.timedelta(x["days"] - 1) for x in found)


def test_ready(spark):
    runs = spark.createDataFrame([("a", at(0), True), ("b", at(0), False), ("c", at(-2), True)], "pipeline_name string, start_time timestamp, success boolean")
    needs = spark.createDataFrame([("x", "a"), ("y", "a"), ("y", "b"), ("y", "c"), ("z", None)], "pipeline_name string, needed string")
    got = {r["pipeline_name"]: (r["ready"], r["waits_for"]) for r in backtests.ready(runs, needs, F.lit(at(1))).collect()}
    assert got == {"x": (True, []), "y": (False, ["b", "c"]), "z": (True, [])}
