"""Study-card, decision and corporate-family rules against worked values."""

from pyspark.sql import functions as F

from lodestar.operators import dossier


def test_names_in_text(spark):
    texts = [
        (1, "Nova Inc. (formerly known as Star Co.) and others, formerly known as Dim Light, did it."),
        (2, "It is doing business as Big & Small in Utah; d/b/a Other-One."),
        (3, "Gene Lab, LLC, an indirect wholly owned subsidiary of Nova, signed."),
        (4, None),
    ]
    got = {(r.company_id, r.alias_type, r.alias) for r in dossier.names_in_text(spark.createDataFrame(texts, "company_id int, body string"), "company_id", "body").collect()}
    assert (1, "former_name", "Star Co.") in got and (1, "former_name", "Dim Light") in got
    assert (2, "dba", "Big & Small") in got and (2, "dba", "Other-One") in got
    assert any(i == 3 and k == "subsidiary" and a.startswith("Gene Lab") for i, k, a in got)
    assert not any(i == 4 for i, _, _ in got)


def test_rules_at_their_limits(spark):
    row = spark.range(1).select(
        dossier.risk_factors(F.lit(1), F.lit(0.7), F.lit(5), F.array(F.lit(True), F.lit(True)), F.lit(None).cast("boolean"), F.lit(True), F.lit("PP")).alias("a"),
        dossier.risk_factors(F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(99), F.lit(None).cast("array<boolean>"), F.lit(False), F.lit(True), F.lit("ITT")).alias("b"),
        dossier.fallback_score(F.lit(3), F.lit(1.0)).alias("c"), dossier.fallback_score(F.lit(7), F.lit(0.999)).alias("d"),
        dossier.evidence_quality(F.lit(None).cast("array<struct<loc:string,text_preview:string>>")).alias("e"),
        dossier.simple_tone(F.lit("")).alias("f"), dossier.simple_tone(F.lit("They MAY show it")).alias("g"),
        dossier.coverage_quality(F.lit(None).cast("string")).alias("h"),
    ).first()
    assert row.a == ["Protocol change after LPR (S1)", "Subgroup-only win without primary success", "Subgroup-only win without primary success", "Primary analysis on PP population instead of ITT"]
    assert row.b == ["Small sample size: 99"]
    assert (row.c, row.d, row.e, row.f, row.g, row.h) == (31, 99, 0.0, None, "neutral", 0.5)
