"""The pipeline against plain versions of its stages."""

import re
from collections import Counter

import corpus_pipeline
from lodestar.llm import langid
from pyspark.sql import functions as F
from test_operators import plain_classes, plain_dedup


def test_stages_work_on_what_the_one_before_kept(spark, docs, documents, tmp_path):
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen[name] = [r.asDict() for r in now.collect()]
        if name != "window_packing":
            assert now.columns == list(corpus_pipeline.COLUMNS)
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    left = [d for d in documents if re.search(r"[^\W\d_]", d[1] or "") and found[d[0]]["score"] >= 0.01]
    assert {r["doc_id"] for r in seen["language_id"]} == {d[0] for d in left} and len(left) > 60
    classes = plain_classes(left)
    left = [d for d in left if classes[d[0]][1] == d[0]]
    assert {r["doc_id"] for r in seen["near_dedup"]} == {d[0] for d in left}
    want = {k: "".join(t.split()) for k, (t, _) in plain_dedup(left).items() if t.strip()}
    assert {r["doc_id"]: "".join(r["text"].split()) for r in seen["substring_dedup"]} == want
    copies = Counter(r["doc_id"] for r in seen["source_mixing"])
    assert set(copies) == set(want) and max(copies.values()) <= 2
    assert all("".join(r["text"].split()) == want[r["doc_id"]] for r in seen["source_mixing"])
    pieces = Counter()
    for r in seen["window_packing"]:
        pieces[r["doc_id"]] += r["length"]
        assert r["length"] <= 1024
    assert set(pieces) == set(want)
    assert all(pieces[r["doc_id"]] == r["doc_tokens"] * copies[r["doc_id"]] for r in seen["window_packing"])


def test_repeated_rows_stay_through_both_dedup_stages(spark):
    text = "a clean document whose only line is long enough"
    data = [(7, text, "en", "s", 47), (7, text, "en", "s", 47), (9, text + "\n" + "another line of words that only this one has and that goes on", "en", "s", 0)]
    now = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.substring_dedup):
        now = stage(spark, now, "")
    assert [r["text"] for r in now.collect() if r["doc_id"] == 7] == [text, text]


def test_near_dedup_compares_five_words(spark):
    words = [f"w{k}" for k in range(200)]
    changed = [f"x{k}" if k % 40 == 20 else w for k, w in enumerate(words)]  # 4-word similarity 0.816, 5-word 0.774
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in enumerate((words, changed))], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {0, 1}


def test_run_gives_the_last_stage(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0 and "sequence_id" in out.columns


def test_missing_labels_are_filled_and_empty_tables_pass(spark, docs, empty, tmp_path):
    bare = docs.withColumn("lang", F.when(F.col("doc_id") % 7 != 3, F.col("lang")))
    labels = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = corpus_pipeline.language_id(spark, bare, "").where("doc_id < 60").collect()
    assert len(out) == 60 and all(r["lang"] == labels[r["doc_id"]] for r in out)
    empty.withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    text = "a clean document of some words that goes on and on for a while and then ends here"
    data = [(None, text + " again", None, None, None), (3, text, "en", "s", 1), (3, text, "en", "s", 1), (4, None, "en", "s", None), (5, "", "en", None, 0), (6, "z" * 300_000, "en", "s", 5)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(1.0)).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {3} <= got <= {None, 3, 6}
