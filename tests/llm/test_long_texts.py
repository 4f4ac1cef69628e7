"""Learning from texts of any length, and results held against plain versions."""

import math
import random
import re
import zlib

import numpy as np
from lodestar.llm import langid, quality_cnn
from pyspark.sql import functions as F

SYLLABLES = {"a": ("ka", "lo", "mi", "tu"), "b": ("sch", "ein", "ung", "ver"), "c": ("oux", "eau", "ille", "que"), "d": ("ño", "ción", "ará", "iendo")}


def text(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def trained(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_a_language_of_long_texts_is_predicted(spark):
    r = random.Random(1)
    rows = [(i, text(r, "abcd"[i % 4], (20, 60, 300, 12_000)[i % 4]), "abcd"[i % 4]) for i in range(160)]
    rows = [x for x in rows if x[2] != "d" or x[0] < 40]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("length", F.lit(3))
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(df).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_a_huge_text_alone_gives_its_language(spark):
    r = random.Random(2)
    first = next(i for i in range(1000, 2000) if trained(i))
    rows = [(first, "1234 " * 3000 + text(r, "c", 60_000), "c")] + [(i, text(r, "a", 30), "a") for i in range(40)] + [(i, text(r, "c", 30), None) for i in range(50, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(df).collect()}
    assert all(got[i] == "c" for i in [first, *range(50, 60)]) and all(got[i] == "a" for i in range(40))
    sample = langid.sample_texts(df, "doc_id", "text", "lang", F.lit(True), 48, 800)
    assert len(sample["c"]) <= 850 and sample["c"].count("1234") < 3000


def plain_costs(samples, body):
    """Phrases by looking for the longest part of the sample that comes next, character by character."""
    words = body.lower().split()
    out = {}
    for lang, sample in samples.items():
        phrases = 0
        for w in (f" {w} " for w in words):
            at = 0
            # the end of a word is a phrase of its own no more than its start is
            while at < len(w):
                n = 0
                while at + n < len(w) and w[at : at + n + 1] in sample:
                    n += 1
                phrases += 1
                at += max(1, n)
        out[lang] = phrases * math.log2(max(2, len(sample))) / max(1, sum(map(len, words)) + len(words))
    return out


def test_language_and_score_equal_longest_matches_by_search(spark):
    r = random.Random(3)
    rows = [(i, text(r, "abc"[i % 3], r.randint(3, 40)) + (" " + text(r, "abc"[(i + 1) % 3], r.randint(1, 25)) if i % 4 == 0 else ""), "abc"[i % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = langid.clean_samples(langid.sample_texts(df, "doc_id", "text", "lang", F.col("_i").isin([i for i, *_ in rows if trained(i)]), 48, 800))
    for x in langid.identify(df).collect():
        costs = sorted((c, lang) for lang, c in plain_costs(samples, dict((i, t) for i, t, _ in rows)[x["doc_id"]]).items())
        assert x["lang_pred"] == costs[0][1] or math.isclose(costs[0][0], costs[1][0])
        assert math.isclose(x["score"], 1 - costs[0][0] / costs[1][0], abs_tol=1e-9)


def long_labelled(n=90):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        bad = i % 2 == 0
        body = text(r, "a", 7_000)
        if bad:
            body = re.sub(r" (\w+) (\w+) (\w+)", r" \1## \2!! $$$\3", body)
        rows.append((i, body))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_labels_on_long_texts_alone_are_learned(spark):
    rows, labels = long_labelled()
    assert min(len(t) for _, t in rows) > 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {x["doc_id"]: x["score"] for x in quality_cnn.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    held = [i for i, _ in labels if not trained(i)]
    good, bad = ([out[i] for i in held if i % 2 == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def plain_score(net, body):
    """The forward pass with loops: windows of WIDTH bytes, halves, chunks of two halves, pools."""
    stride, half, width = quality_cnn.STRIDE, quality_cnn.HALF, quality_cnn.WIDTH
    buf, first, valid = quality_cnn.layout([body])
    met = quality_cnn.stutter(buf)
    halves = []
    for h in range(int(first[0]), int(first[1])):
        acts = []
        for k in range(int(valid[h])):
            at = h * half + k * stride
            codes = buf[at : at + width]
            x = np.concatenate([np.concatenate([net.p["embed"][c], [np.float32(s)]]) for c, s in zip(codes, met[at : at + width], strict=True)])
            acts.append(np.maximum(x @ net.p["conv"] + net.p["bias"], 0))
        halves.append(acts)
    chunks = [h + (halves[k + 1] if k + 1 < len(halves) else []) for k, h in enumerate(halves)]
    chunks = [c for k, c in enumerate(chunks) if k == 0 or len(c) >= 16]
    means = np.array([np.mean(c, axis=0) if c else np.zeros(len(net.p["mix"])) for c in chunks])
    return float(1 / (1 + np.exp(-(means.max(axis=0) @ net.p["mix"] + means.min(axis=0) @ net.p["mix_low"] + net.p["out"])))[0])


def test_score_equals_the_forward_pass_with_loops(spark):
    r = random.Random(6)
    texts = ["", "x", "ab ab ab ab", text(r, "b", 25), text(r, "c", 90), text(r, "d", 400), "é" * 700]
    net = quality_cnn.train([t.encode() for t in texts], np.array([0, 1, 0, 1, 0, 1, 0]), steps=20)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["score"] for x in quality_cnn.classify(df, spark.createDataFrame([], "doc_id long, quality int"), network=net).collect()}
    for i, t in enumerate(texts):
        assert math.isclose(got[i], plain_score(net, t.encode()), abs_tol=1e-5), i
