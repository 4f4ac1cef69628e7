"""Notes on texts against plain regular expressions, and at their limits."""

import re

from pyspark.sql import functions as F

from lodestar.operators import notes

TEXT = (
    "Small Sample of n < 40, open\nlabel.  Table 2: Baseline results. Figure 1A. Kaplan plot\nJapan and japan; JAPAN, Japanese in Japan. "
    "Supported by Grant NIH12345 of Health Institute and Acme inc.x 'a significant mismatch of primary vs secondary' \"we conclude that it works, thus good\" "
    "Consulting fees from Pfizer Ltd; missing data, protocol amendment and  dropout. Été 𝒳 bias. Impact factor: 12.5, bioRxiv preprint, PMID: 123"
)
CARD = '{"sample_size":{"total_n":50,"power":0.756},"trial":{"status":"Terminated"},"primary_endpoints":[1,2,3,4],"results":{"primary":[{"p_value":"0.0002"},{"p_value":0.5},{"p_value":"x"}]},"populations":{"dropouts_overall_pct":25,"analysis_primary_on":"PP"},"protocol_changes":[{"post_LPR":true,"change":"dose"},{"post_LPR":false}]}'


def plain(text, patterns):
    return [(kind, m.group(), m.start(), m.end()) for kind, ps in patterns.items() for p in ps for m in re.finditer(p, text, re.IGNORECASE)]


def test_matches_and_offsets_equal_plain_search(spark):
    long = "dropout, n<5 " * 3000
    df = spark.createDataFrame([(0, TEXT), (1, None), (2, ""), (3, long), (4, "dropout")], "id int, t string")
    rows = df.select("id", "t", notes.limitations(F.col("t"), most=100_000).alias("l"), notes.oddities(F.col("t")).alias("o"), notes.discrepancies(F.col("t")).alias("d"), notes.conflicts(F.col("t")).alias("c"), notes.funding(F.col("t")).alias("f")).collect()
    for r in rows:
        t = r.t or ""
        assert [(x.type, x.description, x.start, x.end) for x in r.l] == plain(t, notes.LIMITATIONS)
        assert [(x.type, x.description, x.start, x.end) for x in r.o] == plain(t, notes.ODDITIES)[:15]
        assert [(x.type, x.description, x.start, x.end) for x in r.d] == plain(t, notes.DISCREPANCIES)[:15]
        assert [(x.type, x.description, x.start, x.end) for x in r.c] == plain(t, notes.CONFLICTS)
        assert [(x.type, x.start, x.end) for x in r.f] == [(k, a, b) for k, _, a, b in plain(t, notes.FUNDING)]
        assert [x.preview for x in r.l[:9]] == [t[max(0, a - 100) : b + 100].strip() for _, _, a, b in plain(t, notes.LIMITATIONS)[:9]]
    assert len(rows[3].l) == 6000


def test_severity_sources_and_regions(spark):
    t = F.lit(TEXT)
    r = spark.range(1).select(notes.limitations(t).alias("l"), notes.discrepancies(t).alias("d"), notes.region_outliers(t).alias("g"), notes.region_outliers(t, least=6).alias("none")).first()
    how = {x.description.lower(): x.severity for x in r.l}
    assert (how["small sample"], how["missing data"], how["dropout"]) == ("major", "moderate", "major")
    assert [(x.description, x.source1) for x in r.d] == [("mismatch", "Source 1"), ("primary vs secondary", "Primary endpoint")]
    assert [x.region for x in r.g] == ["Japan", "japan", "JAPAN", "Japan"] and r.none == []
    assert {x.impact for x in r.g} <= {"significant", "moderate", "minimal"}


def test_structure_of_a_card(spark):
    c = F.parse_json(F.lit(CARD))
    none = F.lit(None).cast("variant")
    r = spark.range(1).select(
        notes.limitations(F.lit(""), c).alias("l"), notes.oddities(F.lit(None).cast("string"), c).alias("o"), notes.discrepancies(F.lit(""), c).alias("d"),
        notes.limitations(F.lit(""), none).alias("l0"), notes.oddities(F.lit(""), none).alias("o0"), notes.discrepancies(F.lit(""), none).alias("d0"),
    ).first()
    assert [(x.description, x.severity) for x in r.l] == [("Small sample size (n=50)", "major"), ("Underpowered study (power=0.76)", "major"), ("Study terminated early", "critical"), ("Multiple primary endpoints may reduce statistical power", "moderate")]
    assert [x.description for x in r.o] == ["Extremely low p-value (p=0.000200)", "High dropout rate (25%)"]
    assert [(x.description, x.source2) for x in r.d] == [("Primary analysis not on ITT population", "Actual analysis (PP)"), ("Protocol change after LPR", "Modified protocol")]
    assert (r.l0, r.o0, r.d0) == ([], [], [])


def test_publication_tables_figures_and_quotes(spark):
    t = F.lit(TEXT)
    r = spark.range(1).select(notes.publication(t, F.lit("https://doi.org/10.1/x y"), F.lit("j"), F.lit(2024)).alias("p"), notes.table_references(t).alias("t"), notes.figure_references(t).alias("f"), notes.quotes(t).alias("q"), notes.funding(t).alias("g")).first()
    assert (r.p.impact_factor, r.p.open_access, r.p.peer_reviewed, r.p.doi, r.p.pmid, r.p.publication_date) == (12.5, None, False, "10.1", "123", "2024")
    assert [(x.label, x.caption, x.data_types) for x in r.t] == [("2", "Table 2", ["other"]), ("2", "Baseline results", ["demographics", "efficacy"])]
    assert [(x.label, x.figure_type, x.data_types) for x in r.f] == [("1A", "other", ["other"]), ("1A", "kaplan_meier", ["survival"])]
    assert {x.data_type for x in r.q} == {"qualitative", "interpretation"}
    assert all(TEXT[x.start + 1 : x.end - 1] == x.text for x in r.q)
    assert {x.grant_number for x in r.g} == {None}
    kinds = {w: spark.range(1).select(notes.publication(F.lit(w), *[F.lit(None).cast("string")] * 3).journal_type).first()[0] for w in ("in The Lancet poster", "Annals of x", "poster", "x", "")}
    assert list(kinds.values()) == ["high_impact", "specialty", "conference", "general", "general"]
