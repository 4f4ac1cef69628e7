"""Work by the row that must not grow with tables of rules, points or keys; seen in the plans."""

import re

import pytest
from pyspark.sql import functions as F

from lodestar.operators import cards, extract, fit, notes, versions


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_calibrated_scores_are_looked_up_by_place(spark):
    held = spark.createDataFrame([(0.1, 10, 1.0), (0.4, 10, 3.0), (0.7, 10, 9.0)], "m double, n long, p double")
    curve = fit._isotonic(held)
    got = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.25, 0.4, 0.5, 1.0)], "m double").select(curve(F.col("m")).alias("y"))
    assert "lambda" not in plan(got)  # no search among the points
    assert [r["y"] for r in got.collect()] == pytest.approx([0.1, 0.1, 0.2, 0.3, 0.5, 0.9])


def test_paths_of_cards_are_constants(spark):
    df = spark.range(3).select(F.parse_json(F.lit('{"trial": {"phase": "3"}}')).alias("card"), "id").withColumn("card", F.when(F.col("id") < 5, F.col("card")))
    found = df.select(cards.fields(F.col("card")).alias("f"))
    assert not re.search(r"variant_get\([^,]*, lambda", plan(found))
    assert found.select(F.expr("filter(f, x -> x.field = 'phase')[0].status").alias("s")).first()["s"] == "extracted"


def test_exploded_words_are_never_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "blue ring and bolt"), (2, "Blue Ring")], "id long, text string")
    names = spark.createDataFrame([("blue", 1), ("blue ring", 2)], "alias_norm string, asset_id int")
    for most, how in ((100, "rightHint=(strategy=broadcast)"), (1, "rightHint=(strategy=merge)")):
        monkeypatch.setattr(extract, "BROADCAST", most)
        hits = extract.dictionary_hits(docs, "id", "text", names)
        assert how in plan(hits)
        assert sorted(map(tuple, hits.collect())) == [(1, "blue", 1), (1, "blue ring", 2), (2, "blue", 1), (2, "blue ring", 2)]


def test_json_is_parsed_once_for_all_keys(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"x": 1, "y": 2}}', '{"b": {"y": 2, "x": 1}, "a": 2}')], "old string, new string")
    diff = df.select(versions.json_diff(F.col("old"), F.col("new")).alias("d"))
    assert plan(diff).lower().count("parsejson") <= 2
    assert [(r["key"], r["type"]) for r in diff.first()["d"]] == [("a", "modified")]
    assert plan(df.select(versions.plan_change(F.col("old"), F.col("new")))).lower().count("parsejson") <= 4


def test_patterns_of_notes_are_constants(spark):
    df = spark.createDataFrame([("a small sample; severe dropout",)], "t string")
    found = df.select(notes.limitations(F.col("t")).alias("m"))
    assert not re.search(r"regexp_extract_all\([^,]*,[^,]*, concat\(\(\?iuU\), lambda", plan(found))
    assert "small sample" in [r["description"] for r in found.first()["m"]]


# --- ranking, signals and gates ---------------------------------------------------------------------------------------


def test_first_rows_have_the_positions_of_all_rows(spark):
    from lodestar.operators import catalyst

    df = spark.range(500).selectExpr("id", "id % 7 AS a", "CASE WHEN id % 3 > 0 THEN id % 5 END AS b").repartition(9)
    order = [F.desc("a"), F.asc("b"), F.asc("id")]
    want = sorted(tuple(r) for r in catalyst.number_rows(df, order).where("position <= 50").collect())
    assert sorted(tuple(r) for r in catalyst.first_rows(df, order, 50).collect()) == want
    assert catalyst.first_rows(df.limit(3), order, 50).count() == 3


def test_ranking_writes_only_what_it_orders_by_and_tells(spark, monkeypatch):
    from lodestar.operators import catalyst
    from lodestar.plans import trial_queries

    seen, kept = [], catalyst.kept
    monkeypatch.setattr(catalyst, "kept", lambda df: seen.append(df.columns) or kept(df))
    trial_queries.ct8_ranking(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and not {"p_fail", "score", "window_start", "window_end"} & set(seen[0])
    trial_queries.bt2_precision_at_k(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1  # the first 50 are not taken from a numbering of all


def test_signals_are_told_before_rows_are_dealt_out(spark):
    from lodestar.plans import trial_queries

    lines = plan(trial_queries.sga_fired_signals(spark, "/root/testdata/sf0.001")).splitlines()
    met = lines[: next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)]
    assert not any("aggregate(sequence" in line or "SQRT" in line for line in met)  # tails by programme, power by card
    made = next(i for i, line in enumerate(met) if "explode" in line)
    assert any("Aggregate" in line for line in met[made:])  # counted before they are made rows of


def test_gates_that_are_not_asked_for_cost_nothing(spark):
    from lodestar.operators import gates
    from lodestar.plans import trial_queries

    assert "SQRT" not in plan(trial_queries.sc6_ratio_calibration(spark, "/root/testdata/sf0.001"))
    gated = trial_queries._gated(spark, "/root/testdata/sf0.001")
    both = [sorted(map(tuple, df.select("trial_id", "G_id", "lr").collect())) for df in (gates.fired_only(gated).where("G_id IN ('G1', 'G3')"), gates.fired_only(gated, ("G1", "G3")))]
    assert both[0] == both[1]


def test_texts_of_sections_are_read_in_one_pass(spark, monkeypatch):
    from lodestar.operators import json_trees

    def never(df):
        raise AssertionError("a level is written")

    monkeypatch.setattr(json_trees, "kept", never)
    bodies = [
        '{"results": {"z": "a", "n": 1.5, "l": ["b", {"y": "c"}, [{"u": "lost"}]]}, "doc": ["bare", {"t": "d"}, [["x"]]], "trial": "no", "skip": {"k": "no"}}',
        '{"doc": {"a": {"b": {"c": ["", "e", null, true]}}}}', '{"doc": {"a": "x", "a": "y"}}', '{"doc": {"a": 1}}', "{", '[{"doc": {"a": "x"}}]', None, '"doc"',
    ]
    df = spark.createDataFrame([*enumerate(bodies), (3, '{"doc": {"a": "again"}}'), (3, '{"doc": {"b": "and", "c": "more"}}')], "id int, body string")
    got = {r["id"]: r["text"] for r in json_trees.section_texts(df, "id", "body").collect()}
    assert got == {0: "d a b c", 1: " e", 3: "again and more"}
