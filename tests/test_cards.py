"""Study cards at their limits."""

import json

from pyspark.sql import functions as F

from lodestar.operators import cards

CARDS = [
    None,
    "{}",
    "null",
    '{"trial":{"nct_id":"NCT01234567","phase":"1b","indication":"abc","is_pivotal":false,"start_date":"01/02/2024","completion_date":""},"primary_endpoints":[{"loc":"x"}],"results":{"primary":[{"source":"y"}]},"sample_size":{"total_n":1,"power":1.0}}',
    '{"trial":[1],"sample_size":true,"primary_endpoints":{},"populations":{"itt":{"a":1},"pp":{"defined":true},"analysis_primary_on":"PP"},"evidence":{"pages":[{"reference":"p"}]}}',
]


def run(spark, *columns):
    df = spark.createDataFrame(list(enumerate(CARDS)), "id int, t string").withColumn("c", F.parse_json("t")).withColumn("e", cards.evidence(F.col("t")))
    return [r for r in df.select("id", *columns).orderBy("id").collect()]


def test_fields_and_summary(spark):
    f = cards.fields(F.col("c"))
    rows = run(spark, f.alias("f"), cards.fields_summary(f).alias("s"))
    assert [len(r.f) for r in rows[:3]] == [0, 0, 0] and rows[0].s.avg_confidence == 0.0 and rows[0].s.total_fields == 0
    assert {x.field: x.status for x in rows[3].f} == {
        "nct_id": "extracted", "phase": "extracted", "indication": "extracted", "is_pivotal": "extracted", "start_date": "extracted", "completion_date": "invalid",
        "primary_endpoints": "extracted", "primary_results": "extracted", "sample_size": "extracted", "power_calculation": "extracted",
    }
    assert {x.field for x in rows[4].f if x.status == "missing"} == {"nct_id", "phase", "indication", "is_pivotal", "primary_results"}
    assert {x.field: x.status for x in rows[4].f}["primary_endpoints"] == "invalid"
    assert len(cards.FIELDS) == 47


def test_issues_and_grades(spark):
    i, s = cards.issues(F.col("c"), F.col("e")), cards.fields_summary(cards.fields(F.col("c")))
    rows = run(spark, i.alias("i"), cards.validation(i, s).alias("v"), "e")
    assert [(r.v.score, r.v.grade, r.v.overall) for r in rows[:3]] == [(100, "A", 100.0)] * 3
    assert rows[3].i == [] and rows[3].v.overall == 70 + 30 * 9 / 10
    assert [(x.field, x.level) for x in rows[4].i] == [
        ("nct_id", "error"), ("phase", "error"), ("indication", "error"), ("is_pivotal", "error"), ("primary_endpoints", "warning"), ("primary_results", "error"), ("primary_results", "warning"),
        ("population_consistency", "warning"), ("evidence_quality", "warning"),
    ]
    assert (rows[4].v.score, rows[4].v.grade) == (42, "F")
    assert [(x.field_path, x.evidence_type) for x in rows[4].e] == [("evidence.pages[0]", "reference")]


def test_evidence_of_odd_texts_and_depth():
    deep = {"primary_endpoints": [{"a": {"b": {"c": [{"evidence": {"k": 1}}, [{"evidence": "not in a list of lists"}]]}}}]}
    assert cards.evidence_of(deep) == [{"field": "primary_endpoints", "field_path": "primary_endpoints[0].a.b.c[0]", "evidence_type": "evidence", "value": json.dumps({"k": 1})}]
    assert cards.evidence_of({"primary_endpoints": "x", "results": None}) == []


def test_raw_cards_without_anything(spark):
    c = F.col("c")
    rows = run(spark, cards.card_errors(c).alias("x"), cards.metadata(c).alias("m"), cards.enrichment(c).alias("n"))
    missing = [f"Missing required field: {f}" for f in cards.NEEDED]
    assert all(r.x == missing for r in rows[:4])
    assert rows[1].m.sponsor == "unknown" and rows[1].m.total_sample_size is None
    assert rows[1].n.risk_factors == ["small_sample_size"] and (rows[1].n.completeness, rows[1].n.data_quality) == (0.0, 1.0)


def test_raw_card_errors(spark):
    card = '{"study_id":"%s","is_pivotal":true,"primary_type":"x","arms":{"a":{"n":"1.5"},"b":{"n":200000},"c":{"n":null},"d":{"n":7.9}},"analysis_plan":[],"primary_result":{"i":3,"j":{"p":"x"},"k":{"p":null}},"subgroups":{}}' % ("s" * 101)
    got = spark.range(1).select(cards.card_errors(F.parse_json(F.lit(card)))).first()[0]
    assert got == [
        "Study ID too long (max 100 characters)", "Arm a sample size must be a valid integer", "Arm b sample size too large (max 100,000)", "Analysis plan must be a dictionary",
        "Primary result i must be a dictionary", "P-value in j must be a valid number", "Subgroups must be a list",
    ]


def test_enrichment_of_tables_reads_values_once(spark):
    """The same as of columns on odd cards, with loops only over what a card lists (before: at every mention of a value)."""
    odd = [
        None, "{}", "[]", "3", '"x"', '{"arms":null,"analysis_plan":[],"primary_result":3,"subgroups":{}}',
        '{"study_id":false,"is_pivotal":"false","primary_type":0,"arms":{"a":{"n":"12","dropout":null},"b":{"n":7.9},"c":{"n":true},"d":4,"e":{"n":"1.5"}},"analysis_plan":{"alpha":"0.1","one_sided":1,"planned_interims":"4"}}',
        '{"sponsor":"PFIZER","indication":"Skin Tumor","phase":"Phase_2B","arms":{"a":{"n":20000}},"analysis_plan":{"alpha":true,"planned_interims":2.9},"primary_result":{"a":{"p":null},"b":{"p":"0.5"},"c":{"p":-1},"d":1},"subgroups":[1,{"name":null},{"n":2},{"name":[1]}],"endpoint_changed_after_lpr":[0]}',
    ]
    df = spark.createDataFrame(list(enumerate(odd)), "id int, t string").select("id", F.parse_json("t").alias("c"))
    for whole, column in ((cards.with_enrichment, cards.enrichment), (cards.with_metadata, cards.metadata)):
        got = whole(df, "c", "id")
        want = df.select("id", column(F.col("c")).alias("x")).select("id", "x.*")
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction(") < 12
        if whole is cards.with_metadata:
            assert [r.one_sided for r in got.orderBy("id").collect()] == [False] * 6 + [True, False]
