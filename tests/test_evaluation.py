"""Positions within ranks and rankings that are kept."""

import datetime as dt

from lodestar.operators import evaluation
from pyspark.sql import functions as F


def test_positions_within_a_rank(spark):
    cards = spark.createDataFrame([(1, 1, 4, 0.5), (2, 1, 4, 0.9), (3, 1, 4, None), (4, 1, 7, 0.2), (5, 1, None, 0.3), (6, 1, 4, 0.5)], "study_id long, trial_id long, base_rank int, quality double")
    judged = spark.createDataFrame([(1, 1, 50, 0.8), (1, 1, 45, 0.9), (4, 1, 99, 1.0), (8, 8, 1, 1.0)], "study_id long, trial_id long, enhanced int, confidence double")
    got = [tuple(r) for r in evaluation.resolved_positions(cards, judged).orderBy("relative_position").collect()]
    assert [(r[0], r[3], r[4], r[5]) for r in got] == [(2, 58, 0.5, 1), (1, 50, 0.8, 2), (6, 46, 0.5, 3), (3, 31, 0.5, 4)]
    assert evaluation.resolved_positions(cards.limit(0), judged).collect() == []


def test_rankings_are_replaced_per_evaluator(spark):
    kind = "trial_id long, evaluator_id string, score_1_10 int, confidence_level int, reasoning_text string, created_at date, updated_at date"
    old, now = dt.date(2024, 1, 1), dt.date(2024, 6, 1)
    current = spark.createDataFrame([(1, "auto", 3, 1, "x", old, old), (1, "human", 9, 5, "y", old, old)], kind)
    incoming = spark.createDataFrame([(1, 5, 0.79, ["a", "b"]), (2, 8, 1.0, []), (2, 7, 0.1, ["z"])], "trial_id long, quality_rank int, confidence double, notes array<string>")
    once = evaluation.save_rankings(current, incoming, "auto", F.lit(now))
    want = [(1, "auto", 5, 3, "a\nb", old, now), (1, "human", 9, 5, "y", old, old), (2, "auto", 8, 5, "", now, now)]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in evaluation.save_rankings(once, incoming, "auto", F.lit(now)).collect()) == want
