"""Very long texts, ties and clashing names for operators whose other tests have none; the posterior by brute force."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from lodestar.llm import langid, mixing, near_dups, packing, token_counts, unit_dedup, weak_rules
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string"


def words(r, n):
    return ["".join(r.choice(("ka", "lo", "mi", "tu", "re", "san")) for _ in range(r.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def long_docs():
    r = random.Random(11)
    base = words(r, 30_000)
    near = [("zz" if k % 3000 == 0 else w) for k, w in enumerate(base)]
    lines = "\n".join(" ".join(words(r, 30)) for _ in range(900))
    return [(1, " ".join(base), "en", "a"), (2, " ".join(near), "en", "a"), (3, "x" * 200_000, "en", "b"), (4, lines, "en", "b"), (5, "Own start of words here.\n" + lines, "en", "b"), (6, "short text", "en", None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_long_texts_are_counted_and_packed_whole(spark, long_docs):
    df = frame(spark, long_docs)
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = {x["doc_id"]: (x["n_pretokens"], x["n_tokens"]) for x in token_counts.count_tokens(df, path).collect()}
    pieces = token_counts.load_pieces(path)
    for i, t, *_ in long_docs:
        w = t.split()
        assert got[i] == (len(w), sum(token_counts.trie_counts(["▁" + x for x in w], pieces))), i
    rows = packing.pack(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    for i, *_ in long_docs:
        own = sorted((x["start"], x["length"], x["doc_tokens"]) for x in rows if x["doc_id"] == i)
        assert [a for a, *_ in own] == list(itertools.accumulate([0, *(n for _, n, _ in own[:-1])])) and sum(n for _, n, _ in own) == own[0][2]
    assert max(x["length"] for x in rows) <= 1024


def test_long_texts_are_deduplicated_and_linked(spark, long_docs):
    df = frame(spark, long_docs)
    classes = {x["doc_id"]: x["component_id"] for x in near_dups.classes(df).collect()}
    assert classes == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6}
    left = {x["doc_id"]: x["text"] for x in unit_dedup.deduplicate(df).collect()}
    assert left[4] == long_docs[3][1] and left[5].strip() == "Own start of words here." and left[3] == long_docs[2][1]


def test_long_texts_keep_their_weight_in_a_mixture(spark, long_docs):
    rows = mixing.mix(frame(spark, long_docs), max_repeat=2.0).collect()
    assert {x["doc_id"] for x in rows} == {i for i, *_ in long_docs}
    assert {x["doc_id"]: x["n_tokens"] for x in rows} == {i: len(t.split()) for i, t, *_ in long_docs}


def test_ties_go_to_the_first(spark):
    same = "kalo mire tusan loka mitu resan kami lotu"
    trained = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, same, lang, "s") for i, lang in zip(trained, "bacbac" * 6, strict=False)]
    got = {x["lang_pred"] for x in langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"a"}
    sets = spark.createDataFrame([(i, same, "a", "s") for i in (9, 4, 7, 4)], SCHEMA)
    assert sorted((x["doc_id"], x["component_id"], x["kept"]) for x in near_dups.classes(sets).collect()) == [(4, 4, True), (4, 4, True), (7, 4, False), (9, 4, False)]
    left = unit_dedup.deduplicate(spark.createDataFrame([(i, " ".join([same] * 5), "a", "s") for i in (3, 2, 8)], SCHEMA)).collect()
    assert {x["doc_id"]: bool(x["text"].strip()) for x in left} == {2: True, 3: False, 8: False}


def test_names_that_clash_change_nothing(spark):
    r = random.Random(5)
    plain = frame(spark, [(i, " ".join(words(r, 60)), "ab"[i % 2], "s") for i in range(12)])
    odd = plain.withColumns({c: F.lit("x") for c in ("score", "kept", "n_tokens", "_t", "_i", "_l", "h1", "count", "start", "length", "component_id", "removed", "block", "epoch", "_src", "_part", "quality", "n_words")})
    path = public_tokenizers.path("byte_bpe_50k.json")
    for f in (near_dups.classes, unit_dedup.deduplicate, langid.identify, weak_rules.judge, mixing.mix, lambda d: packing.pack(d, path)):
        first = f(plain)
        assert sorted(map(str, first.collect())) == sorted(map(str, f(odd).select(*first.columns).collect()))


@pytest.mark.parametrize(("f", "name"), [(unit_dedup.deduplicate, "removed"), (langid.identify, "score"), (mixing.mix, "block")])
def test_carried_names_that_clash_are_an_error(spark, f, name):
    with pytest.raises(ValueError):
        f(spark.createDataFrame([(1, "a b", "en", "s")], SCHEMA).withColumn(name, F.lit(1)), carry=(name,))


def test_posterior_equals_expectation_maximisation_over_texts(spark):
    r = random.Random(3)
    texts = []
    for k in range(160):
        w = words(r, r.choice((10, 49, 50, 80, 300)))
        if k % 4 == 0:
            w = [x + r.choice(("", "###", "!!!", "%")) for x in w]
        if k % 5 == 0:
            w = w[:6] * (len(w) // 6)
        if k % 7 == 0:
            w = [x.upper() for x in w]
        texts.append((k, r.choice((" ", "\n")).join(w), "en", "s"))
    rows = weak_rules.judge(spark.createDataFrame([*texts, (900, None, "en", "s"), (901, "", "en", "s")], SCHEMA)).collect()
    names = [c for c in rows[0].asDict() if c.startswith("vote_")]
    votes = np.array([[x[c] for c in names] for x in rows], dtype=float)
    prior, right = 0.7, np.full(len(names), 0.8)
    for _ in range(300):  # over texts, one row each, not over patterns
        logit = math.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right))
        good = 1 / (1 + np.exp(-logit))
        said = votes != 0
        agree = np.where(votes > 0, good[:, None], 1 - good[:, None]) * said
        fresh = np.clip((10 * 0.8 + agree.sum(axis=0)) / (10 + said.sum(axis=0)), 0.5, 0.999)
        done = np.abs(fresh - right).max() < 1e-10
        right = fresh
        if done:
            break
    want = 1 / (1 + np.exp(-(math.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right)))))
    got = np.array([x["quality"] for x in rows])
    assert np.allclose(got, want, atol=1e-6)
    assert [x["kept"] for x in rows] == [bool(q >= 0.5 and not x["base_failed"]) for q, x in zip(want, rows, strict=True)]
    assert 20 < sum(x["kept"] for x in rows) < 140


def test_word_breaks_are_ascii_only(spark):
    text = "one two three\x0bfour\x1cfive"
    row = weak_rules.judge(spark.createDataFrame([(1, text, "en", "s")], SCHEMA)).first()
    assert row["n_words"] == len(re.findall(r"[^\x20\x09-\x0D]+", text)) == 2
