"""Resolution, extraction, quality, tables, sources."""

import json

import pytest
from pyspark.sql import functions as F

from lodestar.functions import dates
from lodestar.functions import text as T
from lodestar.functions.udfs import html_sections, html_text, jaro_winkler_text
from lodestar.operators import extract, monitor, quality, resolve
from lodestar.operators import tables as ops
from lodestar.plans import registry
from lodestar.sources import readers


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("column", "value", "want"), [
    (T.norm_name, "Société AB-123, Inc.", "societe ab-123 inc"),
    (T.norm_loose, "Smith and Jones & Co", "smith jones co"),
    (T.strip_legal, "Acme Holdings Co., Ltd.", "acme"),
    (T.strip_legal, "Inc", ""),
    (T.acronym, "The Dana-Farber Cancer Institute of Boston", "DCB"),
    (T.tokens, "AB-123 of X", ["ab-123", "of", "x"]),
    (T.strong_tokens, "Pharma Genentech Inc", ["genentech"]),
    (T.trigrams, "Cat", ["  c", " ca", "cat", "at "]),
    (T.domains, "see http://www.Acme.com/x and bio.acme.co.uk.", ["acme.com", "bio.acme.co.uk"]),
    (T.norm_name, None, ""),
])
def test_names(spark, column, value, want):
    assert one(spark, value, column) == want


@pytest.mark.parametrize(("a", "b", "want"), [("acme bio", "acme biotech", 0.933333), ("martha", "marhta", 0.961111), ("abcd", "abxyz12", 0.676190), ("alpha", "omega beta", 0.433333), ("", "a", 0.0), ("x", "x", 1.0)])
def test_jaro_winkler(a, b, want):
    assert jaro_winkler_text(a, b) == pytest.approx(want, abs=1e-6)


def test_cascade_takes_only_unique_hits(spark):
    companies = spark.createDataFrame([(1, "Alpha and Beta Inc", None), (2, "Gamma", "gamma.com"), (3, "Twin", None), (4, "Twin", None)], "company_id int, name string, website_domain string")
    aliases = spark.createDataFrame([(2, "Old Gamma", "former"), (1, "shared", "aka"), (2, "Shared", "aka"), (3, "dom.org", "domain")], "company_id int, alias string, alias_type string")
    sponsors = spark.createDataFrame([("old gamma",), ("ALPHA & BETA inc",), ("twin",), ("shared",), ("mail x@www.gamma.com",), ("at dom.org",), ("nobody",), (None,)], "sponsor string")
    got = {r.sponsor: (r.company_id, r.step) for r in resolve.deterministic(sponsors, companies, aliases).collect()}
    assert got == {"old gamma": (2, "alias_strict"), "ALPHA & BETA inc": (1, "name_loose"), "mail x@www.gamma.com": (2, "website"), "at dom.org": (3, "alias_domain")}


def test_decisions_and_margin(spark):
    scored = spark.createDataFrame([("a", 1, 0.95), ("a", 2, 0.93), ("b", 1, 0.95), ("c", 1, 0.7), ("d", 1, 0.1)], "sponsor string, company_id int, p double")
    got = {r.sponsor: (r["mode"], r.company_id) for r in resolve.decide(scored).collect()}
    assert got == {"a": ("review", 1), "b": ("accept", 1), "c": ("review", 1), "d": ("reject", None)}


def test_roll_up_of_long_chains_and_cycles(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(75)] + [("p", "q"), ("q", "p"), ("q", "r"), ("t", "n40")]
    got = {(r.child, r.top): r.depth for r in resolve.roll_up(spark.createDataFrame(edges, "parent string, child string")).collect()}
    assert all(got[f"n{i}", "n0"] == i for i in range(1, 76)) and got["n75", "t"] == 36
    assert not any(c in "pqr" for c, _ in got)


def test_code_shapes_overlap(spark):
    docs = spark.createDataFrame([(1, "A-123 and AB-1X and AB12C and BMS-A-001 with ABCDE-12")], "doc_id int, text string")
    assert {r.value_norm for r in extract.codes(docs, "doc_id", "text").collect()} == {"A-123", "A-001", "BMS-A-001", "AB-1X", "AB12C"}


def test_roll_up_depths(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y")], "parent string, child string")
    assert {(r.child, r.top, r.depth) for r in resolve.roll_up(edges).collect()} == {("b", "a", 1), ("c", "a", 2), ("d", "a", 3), ("y", "x", 1)}


def test_codes_links_and_distance(spark):
    text = "AB-123 starts here. " + "x" * 200 + " NCT01234567 then XYZ-456."
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")
    codes = extract.codes(docs, "doc_id", "text")
    ids = extract.entities(docs, "doc_id", "text", extract.REGISTRY_PATTERN, "nct")
    found = {(r.value_norm, r.char_start) for r in extract.code_variants(codes).collect()}
    assert {("AB-123", 0), ("AB123", 0)} <= found
    pairs = extract.near_pairs(ids, codes.where("value_norm <> 'NCT01234567'"))
    assert {r.right_value for r in pairs.collect()} == {"AB-123", "XYZ-456"}
    assert all(text[r.char_start : r.char_end] == r.value_text for r in codes.collect())


def test_near_pairs_at_the_limit(spark):
    row = "doc_id int, page_no int, value_norm string, char_start int, char_end int"
    a = spark.createDataFrame([(1, 1, "a", 0, 0)], row)
    b = spark.createDataFrame([(1, 1, "near", 250, 250), (1, 1, "far", 251, 251), (1, 2, "page", 10, 10)], row)
    assert [r.right_value for r in extract.near_pairs(a, b).collect()] == ["near"]


@pytest.mark.parametrize(("right", "n", "promote"), [(47, 49, False), (48, 50, True), (47, 50, False)])
def test_promotion_gate(spark, right, n, promote):
    rows = [("h", i < right) for i in range(n)] + [("h", None)]
    got = extract.may_promote(extract.link_precision(spark.createDataFrame(rows, "heuristic string, label boolean"))).first()
    assert got.promote == promote and got.links == n + 1 and got.reviewed == n


@pytest.mark.parametrize(("text", "want"), [("topline on Nov 3, 2025", ("2025-11-02", "2025-11-05")), ("Q4 2025", ("2025-10-01", "2025-12-31")), ("H2 2025", ("2025-07-01", "2025-12-31")), ("at ESMO 2025", ("2025-01-01", "2025-12-31")), ("Feb 30, 2025 or so", ("2025-01-01", "2025-12-31")), ("soon", None)])
def test_date_windows(spark, text, want):
    got = one(spark, text, dates.text_window)
    assert (got and (str(got.start), str(got.end))) == want


def test_chunks_and_citations(spark):
    docs = spark.createDataFrame([(1, "one\n\ntwo words\n\n\n\nlast"), (2, ""), (3, None)], "doc_id int, text string")
    got = [(r.para_no, r.start, r.chunk) for r in extract.chunks(docs, "doc_id", "text").orderBy("para_no").collect()]
    assert got == [(0, 0, "one"), (1, 5, "two words"), (3, 18, "last")]
    c = one(spark, "doi 10.1000/xyz123 PMID: 4567", extract.citations)
    assert c.doi == "10.1000/xyz123" and c.pmid == "4567"


def test_rules_on_odd_values(spark):
    rows = [("N1", "t", "s", "PHASE2", "2024-01-01", None, "2024-02-01", "12"), ("N2", "", "s", "PHASE9", "2024-03-01", "2024-01-01", "2024-02-01", "abc"), ("N3", "t", "s", None, "2024-01-01", None, None, None), ("N4", "t", "s", "PHASE3", "2024-01-01", "2024-03-01", "2024-02-01", "0")]
    df = spark.createDataFrame(rows, "nct_id string, brief_title string, sponsor_name string, phase string, study_start string, primary_completion string, study_completion string, enrollment_count string")
    got = {(r.nct_id, r.rule_id.removeprefix("trial_")): r.status for r in quality.check(df, "nct_id", quality.trial_rules()).collect()}
    assert [got["N1", k] for k in ("required_fields", "phase_valid", "dates_consistent", "enrollment_positive")] == ["PASS"] * 4
    assert [got["N2", k] for k in ("required_fields", "phase_valid", "dates_consistent", "enrollment_positive")] == ["FAIL"] * 4
    assert [got["N3", k] for k in ("required_fields", "phase_valid", "dates_consistent", "enrollment_positive")] == ["FAIL", "WARNING", "SKIP", "SKIP"]
    assert [got["N4", k] for k in ("dates_consistent", "enrollment_positive")] == ["FAIL", "FAIL"]
    c = spark.createDataFrame([("0000000001", "n", "ABC"), ("000000001", "n", "ABCDEF"), (None, "n", None)], "cik string, company_name string, ticker string")
    got = [(r.rule_id, r.status) for r in quality.check(c.limit(3), "cik", quality.company_rules()).collect()]
    assert [s for k, s in got if k == "company_cik_format"] == ["PASS", "FAIL", "FAIL"] and [s for k, s in got if k == "company_ticker_format"] == ["PASS", "FAIL", "SKIP"]


def test_ranges_close_and_overlap(spark):
    rows = spark.createDataFrame([("A", "2020-01-01"), ("A", "2021-01-01"), ("B", "2020-05-01")], "ticker string, d string").withColumn("d", F.col("d").cast("date"))
    r = ops.valid_ranges(rows, "ticker", "d")
    assert ops.overlaps(r, "ticker").count() == 0 and r.where("status = 'active'").count() == 2
    closed = ops.close_ranges(r, "ticker", spark.createDataFrame([("A", "2022-01-01")], "ticker string, end string").withColumn("end", F.col("end").cast("date")))
    assert closed.where("ticker = 'A' and status = 'active'").count() == 0 and closed.where("valid_from = valid_to").count() == 1 and ops.overlaps(closed, "ticker").count() == 0
    bad = r.unionByName(spark.createDataFrame([("A",)], "ticker string").selectExpr("ticker", "date'2020-06-01' as d", "date'2020-06-01' as valid_from", "date'2020-07-01' as valid_to", "'x' as status"))
    assert [str(x.valid_from) for x in ops.overlaps(bad, "ticker").collect()] == ["2020-06-01"]


def test_upsert_is_idempotent(spark):
    a = spark.createDataFrame([(1, "a", "old"), (2, "b", None)], "k int, v string, notes string")
    b = spark.createDataFrame([(2, "B", None), (3, "c", "n"), (1, "A", None)], "k int, v string, notes string")
    once = ops.upsert(a, b, ["k"], ("notes",))
    want = {(1, "A", "old"), (2, "B", None), (3, "c", "n")}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in ops.upsert(once, b, ["k"], ("notes",)).collect()}


@pytest.mark.parametrize(("days", "gone"), [(29, False), (30, False), (31, True)])
def test_cleanup_age(spark, days, gone):
    o = spark.createDataFrame([(1, 10)], "object_id int, size_bytes int").withColumn("last_accessed", F.date_sub(F.lit("2024-03-31").cast("date"), days))
    refs = spark.createDataFrame([], "object_id int, reference_type string, entity_id int")
    assert (ops.cleanup_candidates(ops.reference_counts(o, refs), F.lit("2024-03-31").cast("date")).count() == 1) == gone


def test_alert_limits_are_open(spark):
    runs = spark.createDataFrame([("a", True, 10, 1, 3600), ("b", True, 10, 2, 3601), ("c", False, 0, 5, 1)], "execution_id string, success boolean, records_processed int, error_count int, s int")
    runs = runs.withColumn("start_time", F.lit("2024-01-01 00:00:00").cast("timestamp")).withColumn("end_time", F.expr("start_time + make_dt_interval(0, 0, 0, s)"))
    got = {(r.execution_id, r.alert_type) for r in monitor.run_alerts(monitor.run_metrics(runs)).collect()}
    assert got == {("b", "error_rate_high"), ("b", "performance_issue"), ("c", "pipeline_failure")}


def test_registry_and_filings(spark, tmp_path):
    record = {"protocolSection": {"identificationModule": {"nctId": "NCT1"}, "designModule": {"studyType": "Interventional", "phases": ["PHASE2", "PHASE3"]}, "armsInterventionsModule": {"interventions": [{"type": "Drug"}, {"type": "DRUG"}]}, "outcomesModule": {"primaryOutcomes": [{"measure": "OS", "timeFrame": "24 months"}, {"measure": "ORR"}]}, "statusModule": {"primaryCompletionDateStruct": {"date": "2024-05"}, "lastUpdatePostDateStruct": {"date": "2024-01-02"}}}}
    device = {"protocolSection": {"identificationModule": {"nctId": "NCT2"}, "designModule": {"studyType": "INTERVENTIONAL", "phases": ["PHASE2"]}, "armsInterventionsModule": {"interventions": [{"type": "DEVICE"}]}}}
    (tmp_path / "r.json").write_text(json.dumps(record) + "\n{broken\n" + json.dumps(device) + "\n")
    got = readers.trial_fields(readers.in_scope(readers.registry(spark, str(tmp_path / "r.json")))).collect()
    assert len(got) == 1 and got[0].phase == "PHASE2_PHASE3" and got[0].primary_endpoint_text == "OS (24 months); ORR"
    assert str(got[0].primary_completion) == "2024-05-01" and got[0].intervention_types == ["DRUG"]
    assert readers.registry(spark, str(tmp_path / "r.json"), since="2024-01-03").count() == 0
    (tmp_path / "a.json").write_text(json.dumps({"fields": ["cik", "name", "ticker", "exchange"], "data": [[1, "A", "AA", "NYSE"]]}))
    (tmp_path / "b.json").write_text(json.dumps({"0": {"cik_str": 2, "title": "B", "ticker": "BB"}}))
    (tmp_path / "c.json").write_text(json.dumps([{"cik": 3, "name": "C", "ticker": "CC"}]))
    for f, want in (("a", ("0000000001", "A", "AA")), ("b", ("0000000002", "B", "BB")), ("c", ("0000000003", "C", "CC"))):
        assert [(r.cik, r.name, r.ticker) for r in readers.company_tickers(spark, str(tmp_path / f"{f}.json")).collect()] == [want]


def test_html(spark):
    page = "<html><style>x</style><body><h1>Item 1</h1><p>Hello <b>there</b></p><script>no</script><h2>Item 2</h2>More&amp;more</body></html>"
    assert one(spark, page, html_text) == "Item 1\nHello there\nItem 2\nMore&more"
    assert [(s.level, s.title, s.body) for s in one(spark, page, html_sections)] == [("h1", "Item 1", "Hello there"), ("h2", "Item 2", "More&more")]


def test_sequence_ratio_of_whole_texts(spark, tmp_path):
    from difflib import SequenceMatcher

    same = " ".join(f"w{k}" for k in range(120))
    turns = [(1, 0, same + " one end"), (1, 1, same + " and quite another end " * 9), (1, 2, "short"), (2, 0, same), (2, 1, same + "x" * 900)]
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r["conv_id"], r["turn"]): r["ratio"] for r in registry.queries()["ch6_sequence_ratio"](spark, str(tmp_path)).collect()}
    texts = {(c, n): t for c, n, t in turns}
    want = {(c, n): round(SequenceMatcher(None, texts[c, n - 1], t).ratio(), 6) for (c, n), t in texts.items() if n}
    assert len(same) > 400 and got == pytest.approx(want, abs=1e-6) and got[2, 1] < 1
