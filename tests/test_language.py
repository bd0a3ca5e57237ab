from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docloom.operators.language import MILLION, LanguageModel, profiles

WORDS = {
    "en": "the of and that with from this have which their would there been".split(),
    "fr": "le la les des que dans pour avec cette sont être même où".split(),
    "de": "der die das und nicht über für eine auch werden können straße".split(),
}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return [(f"/{l}/{i}", l, " ".join(rng.choice(WORDS[l]) for _ in range(30))) for l in WORDS for i in range(20)]


@pytest.fixture(scope="module")
def model(spark, texts):
    return LanguageModel.fit(spark.createDataFrame(texts, "path string, lang string, body string"), size=200)


def grams(text):
    return [f"_{w}_"[i : i + 3] for w in re.findall(r"[^\W\d_]+", text.lower()) for i in range(len(w))]


def test_profiles_against_a_loop(spark, texts):
    df = spark.createDataFrame(texts, "path string, lang string, body string")
    found = {(r["lang"], r["gram"]): r["pf"] for r in profiles(df, size=15).collect()}
    expected = {}
    for lang in WORDS:
        counts = Counter(g for _, l, t in texts if l == lang for g in grams(t))
        total = sum(counts.values())
        for g, n in sorted(counts.items(), key=lambda e: (-e[1], e[0].encode()))[:15]:
            expected[lang, g] = int(n * MILLION / total + 0.5)
    assert found == expected


def test_both_forms_agree_and_are_right(spark, texts, model):
    odd = [("/e", "", ""), ("/n", "", None), ("/d", "", "12 34 _ !"), ("/x", "", "Ωμέγα 𐌰𐌱𐌲 ½ x²"), ("/u", "", "ÜBER STRASSE")]
    df = spark.createDataFrame([*texts, *odd], "path string, lang string, body string")
    for margin in (None, 0.002, 0.05):
        table = {r["path"]: r["lang"] for r in model.detect(df, min_margin=margin).collect()}
        column = {r["path"]: r["l"] for r in df.select("path", model.column(F.col("body"), margin).alias("l")).collect()}
        assert table == column
        assert table["/e"] == table["/n"] == table["/d"] == ""
    plain = {r["path"]: r["lang"] for r in model.detect(df).collect()}
    assert all(plain[p] == l for p, l, _ in texts)
    assert plain["/u"] == "de"


def test_an_impossible_margin_leaves_all_undecided(spark, texts, model):
    df = spark.createDataFrame(texts, "path string, lang string, body string")
    assert {r["lang"] for r in model.detect(df, min_margin=10.0).collect()} == {""}


def test_texts_with_one_path_are_kept_apart(spark, model):
    rows = [("/p", "the of and that with"), ("/p", "der die das und nicht")]
    df = spark.createDataFrame(rows, "path string, body string")
    assert sorted(r["lang"] for r in model.detect(df).collect()) == ["de", "en"]


def test_usable_from_sql(spark, texts, model):
    model.register(spark, "detect_lang")
    spark.createDataFrame(texts, "path string, lang string, body string").createOrReplaceTempView("langs")
    row = spark.sql("SELECT count(*), count_if(detect_lang(body) = lang) FROM langs").first()
    assert row[0] == row[1]


def test_detection_shuffles_nothing(spark, texts, model):
    df = spark.createDataFrame(texts, "path string, lang string, body string")
    tree = model.detect(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tree and tree.count("MapInArrow") == 1


def test_repeated_rows_get_the_verdict_of_one(spark, texts, model):
    short = [(f"/s/{i}", l, t[: 3 + i % 20]) for i, (_, l, t) in enumerate(texts)]
    df = spark.createDataFrame(short, "path string, lang string, body string")
    for margin in (None, 0.002, 0.02):
        once = sorted(model.detect(df, min_margin=margin).collect())
        assert sorted(model.detect(df.union(df), min_margin=margin).collect()) == sorted(once + once)


def test_a_hundred_languages(spark):
    rng = random.Random(8)
    letters = [chr(0x400 + i) for i in range(40)]
    vocabulary = {f"l{n:03}": ["".join(rng.choices(letters, k=5)) for _ in range(12)] for n in range(100)}
    rows = [(f"/{l}", l, " ".join(words * 5)) for l, words in vocabulary.items()]
    df = spark.createDataFrame(rows, "path string, lang string, body string")
    model = LanguageModel.fit(df, size=5000)
    assert model.languages == sorted(vocabulary)
    assert all(r["path"] == f"/{r['lang']}" for r in model.detect(df).collect())


def test_memory_does_not_grow_with_the_batch():
    """Whole batches used to be scored at once: some 200 bytes for each of their characters."""
    import tracemalloc

    import numpy as np

    from docloom.operators import language as L

    codes = np.array(sorted(L._code(g) for g in ("_ab", "abc", "bc_", "_xy", "xyz", "yz_")))
    values = np.arange(12).reshape(6, 2)
    weights = L.Weights(codes, values, np.array([7.0, 9.0]), ["a", "b"])
    texts = ["abc xyz, " * 2000, None, "", "1 2"] * 150 + ["abc-xyz " * 300_000]
    weights.decide(["abc"])
    tracemalloc.start()
    found = weights.decide(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120_000_000
    assert found == [weights.decide([t])[0] for t in texts]


def test_pieces_of_a_text_give_what_the_text_gives():
    import re

    from docloom.operators import language as L

    texts = ["Über den Wolken", None, "a", "", "x1y  zzß\U0001d400q", "word " * 7]
    for size in (1, 2, 3, 5, 100):
        grams = {}
        for first, pieces in L._pieces(texts, size):
            for row, piece in pieces:
                shown = re.sub(r"[\W\d_]", "_", piece)
                grams.setdefault(first + row, []).extend(shown[i - 1 : i + 2] for i in range(1, len(shown) - 1) if shown[i] != "_")
        for number, text in enumerate(texts):
            words = [f"_{w}_" for w in re.findall(r"[^\W\d_]+", (text or "").lower())]
            assert grams.get(number, []) == [w[i : i + 3] for w in words for i in range(len(w) - 2)]
