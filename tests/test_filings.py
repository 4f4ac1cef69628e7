"""Filing, JSON card and queue rules at their limits."""

from pyspark.sql import functions as F

from lodestar.operators import filings

CARD = '{"a":null,"list":[{"x":1.5},{"x":2}],"empty":[],"o":{"k":{"z":true}},"readout":{"expected_date":"2025-02-30","conference":{"name":"ASCO-GI","year":2026}},"single_arm":2,"is_pivotal":"On","sample_size":"","analysis_plan":{"alpha":"nan"}}'


def test_paths_of_a_card(spark):
    c = F.parse_json(F.lit(CARD))
    r = spark.range(1).select(
        filings.value_at(c, "list.*.x").alias("first"), filings.value_at(c, "empty.*.x").alias("none"), filings.value_at(c, "o.k").alias("whole"), filings.value_at(c, "").alias("no_path"),
        filings.value_by_index(c, "list.1.x").alias("second"), filings.value_by_index(c, "list.9.x").alias("beyond"), filings.value_by_index(c, "list.*.x").alias("star"),
        filings.has_key(c, "a").alias("null_counts"), filings.value_at(c, "a").alias("null_value"), filings.has_key(c, "list.x").alias("through_list"),
        filings.array_length(c, "list").alias("n"), filings.array_length(c, "o").alias("no_array"), filings.array_length(F.lit(None).cast("variant"), "x").alias("no_card"),
    ).first()
    assert (r["first"], r.none, r.whole, r.no_path) == ("1.5", None, '{"z":true}', None)
    assert (r.second, r.beyond, r.star) == ("2", None, None)
    assert (r.null_counts, r.null_value, r.through_list) == (True, None, False)
    assert (r.n, r.no_array, r.no_card) == (2, 0, 0)


def test_normalised_card_and_hints(spark):
    c = F.parse_json(F.lit(CARD))
    r = spark.range(1).select(filings.normalised_card(c).alias("c"), filings.hints(c).alias("h"), filings.normalised_card(F.lit(None).cast("variant")).alias("none"), filings.hints(F.lit(None).cast("variant")).alias("no_hints")).first()
    assert (r.c.is_pivotal, r.c.single_arm, r.c.sample_size, r.c.alpha, r.c.planned_interims, r.c.arms, r.c.phase) == (True, True, None, 0.05, None, None, None)
    assert [(h.kind, h.raw_text, str(h.start)) for h in r.h] == [("conference", "results at ASCO-GI 2026", "2026-05-30")]
    assert r.none.alpha is None and r.none.is_pivotal is None and r.no_hints == []


def test_events_without_anything(spark):
    items = spark.createDataFrame([(1, 1, None, [], None, None, None, None), (1, 2, ["safety_signal"], None, ["x"], "NCT1", 0.7, False)], "filing_id int, item int, trial_events array<string>, endpoints_mentioned array<string>, safety_signals array<string>, trial_identifier string, confidence double, requires_review boolean")
    got = {r.item: r for r in filings.trial_events(items).collect()}
    assert (got[1].event_type, got[1].needs_review, got[1].triggers_signals) == ("unknown", True, False)
    assert (got[2].event_type, got[2].needs_review, got[2].triggers_signals) == ("safety_signal", False, True)


def test_reports_on_empty_tables(spark):
    none = spark.createDataFrame([], "id int, overall_tone string, claim_strength map<string,string>, words array<string>, confidence double")
    assert filings.tone_distribution(none).count() == 0 and filings.tone_examples(none, "words", "id").count() == 0
    assert tuple(filings.tone_confidence(none).first()) == (1.0, 0.0, 0.0)
    notes = spark.createDataFrame([], "evaluator_id string, reasoning_text string")
    assert [(r.name, r.n) for r in filings.risk_summary(notes).collect()] == [("high", 0), ("medium", 0), ("low", 0)]


def test_rules_are_skipped_unless_asked(spark):
    t = spark.createDataFrame([(1, 5, None, None, "PHASE9", "PHASE1", None, None)], "trial_id int, enrollment int, start_date date, completion_date date, phase string, last_phase string, sponsor_text string, company_id int")
    assert {r.outcome for r in filings.business_rules(t).collect()} == {"skip"}
    assert sorted(r.outcome for r in filings.business_rules(t, run=True).collect()) == ["fail", "skip", "skip", "skip"]


def test_names_lose_all_endings(spark):
    names = ["Nova Bio, Inc.", "Inc.", None, "Group Nova", "Plum S.A."]
    got = [r.n for r in spark.createDataFrame([(i, x) for i, x in enumerate(names)], "i int, x string").orderBy("i").select(filings.norm_in_text(F.col("x")).alias("n")).collect()]
    assert got == ["nova", "", "", "group nova", "plum s a"]
