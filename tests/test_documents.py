"""The store of fetched pages: batches again, in pieces and out of order."""

from lodestar.operators import doc_store
from lodestar.sources import html
from lodestar.streaming import documents

SCHEMA = "url string, content string, content_type string, source_type string, publisher string, published_at timestamp, fetched_at timestamp"


def page(k):
    return f"<p>Trial NCT{k:08d} of XY-{200 + k} and zetamab.</p><table><tr><td>a<td>b {k}</tr></table>"


def rows(*ks, tag="u"):
    return [(f"{tag}{i}", page(k), "text/html", "PR", "p", None, None) for i, k in enumerate(ks)]


def all_tables(spark, folder):
    out = {}
    for t in doc_store.TABLES:
        df = documents.stored(spark, folder, t)
        out[t] = sorted((tuple(r) for r in df.drop("batch", "source_url").collect()), key=str)
    return out


def test_grids():
    assert html.table_grids("<table><tr><th>a</th><th>b\n c</th></tr><tr><td>1<table><tr><td>in</td></tr></table>2</td></tr><tr></tr></table>out") == [[["a", "b c"], ["12"]], [["in"]]]
    assert html.table_grids("<td>no table</td>") == [] and html.table_grids("<table><td>bare</table>") == [[["bare"]]]


def test_copies_are_one_document(spark):
    data = [*rows(1, 1, 2), ("p", "%PDF", "application/pdf", None, None, None, None), ("n", None, "text/html", None, None, None, None), ("u0", page(1), "text/html", None, None, None, None), ("e", "", None, None, None, None, None)]
    names = spark.createDataFrame([("zetamab", "inn")], "name string, name_type string")
    t = {k: d.collect() for k, d in doc_store.parse(spark.createDataFrame(data, SCHEMA).repartition(3), names).items()}
    assert sorted(r["source_url"] for r in t["documents"]) == ["e", "p", "u0", "u2"]
    assert {len(r["text"]) > 0 for r in t["pages"] if r["char_count"] == 0} == {False} and len(t["pages"]) == 4
    assert sorted((r["ent_type"], r["value_norm"], r["detector"]) for r in t["entities"]) == sorted([("nct", "NCT00000001", "regex"), ("nct", "NCT00000002", "regex"), ("code", "XY-201", "regex"), ("code", "XY-202", "regex")] + [("inn", "zetamab", "dict")] * 2)
    assert sorted((r["link_type"], r["confidence"]) for r in t["links"]) == sorted([("nct_near_asset", 1.0)] * 4 + [("code_in_text", 0.9)] * 2 + [("inn_in_text", 0.85)] * 2)
    assert [r["table_jsonb"] for r in sorted(t["tables"], key=lambda r: r["table_jsonb"])] == ['[["a","b 1"]]', '[["a","b 2"]]']


def test_a_batch_again_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "store")
    one, two = (spark.createDataFrame(rows(*ks), SCHEMA) for ks in ((1, 2), (2, 3, 3)))
    assert documents.stored(spark, folder, "documents") is None
    documents.store_batch(one, 0, folder)
    documents.store_batch(two, 1, folder)
    before = all_tables(spark, folder)
    assert len(before["documents"]) == 3 and len(before["links"]) == 6
    documents.store_batch(two, 1, folder)
    documents.store_batch(one, 0, folder)
    assert all_tables(spark, folder) == before


def test_the_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, folder, mark = (str(tmp_path / x) for x in ("in", "store", "mark"))
    for ks in ((1, 2), (2, 3), (4,)):
        spark.createDataFrame(rows(*ks), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        documents.ingest(spark.readStream.schema(SCHEMA).parquet(source), folder, mark).awaitTermination()
    got = all_tables(spark, folder)
    assert len(got["documents"]) == 4 and len(got["entities"]) == 8
    assert documents.stored(spark, folder, "documents").select("batch").distinct().count() == 3
