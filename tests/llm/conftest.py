"""Documents with every odd case: nulls, empties, blanks, long texts, ties, repeats."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n, syllables=("ka", "lo", "mi", "tu", "re", "san", "vo", "pel")):
    return [("".join(r.choice(syllables) for _ in range(r.randint(1, 4)))) for _ in range(n)]


def sentence(r, n, **k):
    return " ".join(words(r, n, **k)).capitalize() + "."


@pytest.fixture(scope="session")
def documents():
    r = random.Random(3)
    rows = []
    french = ("eau", "oux", "ché", "tré", "ère", "ille", "que")
    base = [sentence(r, 14) for _ in range(12)]
    for i in range(60):
        lang = "fr" if i % 3 == 0 else "en"
        body = " ".join(sentence(r, r.randint(6, 18), **({"syllables": french} if lang == "fr" else {})) for _ in range(r.randint(2, 9)))
        rows.append([i, body.replace(". ", ".\n", 1), lang, f"src{i % 3}" if i % 5 else "big"])
    rows += [[100, " ".join(base), "en", "big"], [101, " ".join(base), "en", "big"], [102, " ".join([*base[:-1], sentence(r, 14)]), "en", "src1"]]
    rows += [[103, None, "en", "src0"], [104, "", "fr", None], [105, " \n\t ", None, "src0"], [106, "1234 5678", "en", "src1"], [107, "Solo", "en", "src2"], [108, "one two", "en", "src2"], [109, "one  two", "fr", "src2"]]
    rows.append([110, " ".join(words(r, 9000)), "en", "big"])
    rows.append([111, "same same same same " * 40, "en", "big"])
    rows.append([112, "NOISE!! WORDS!! " * 60, "en", "src0"])
    rows.append([113, "aa%%% bb### cc*** dd$$$ " * 40, "en", "src0"])
    rows.append([114, f"Lead in here now.\n{base[0]} {base[1]}\nTail of it all and more.", "en", "src0"])
    return [(*x, None if x[1] is None else len(x[1])) for x in rows]


@pytest.fixture(scope="session")
def docs(spark, documents):
    return spark.createDataFrame(documents, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
