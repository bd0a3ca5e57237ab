from __future__ import annotations

import random
from collections import Counter

import numpy as np
from conftest import DOCUMENTS

from docloom.llm import quality
from docloom.llm.queries import QUERIES

WHITE = "[^\x20\x09-\x0d]+"


def brute_counts(text: str | None) -> list[int]:
    import re

    text = text or ""
    words = re.findall(WHITE, text)
    lines, dups = text.split("\n"), 0
    for i, line in enumerate(lines):
        dups += bool(re.search(WHITE, line)) and line in lines[:i]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counted, repeated = Counter(windows), set()
    for i, w in enumerate(windows):
        if counted[w] > 1:
            repeated |= set(range(i, i + 8))
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, len(repeated)]


def test_counts_of_random_texts():
    random.seed(1)
    for _ in range(400):
        text = "".join(random.choice(["a", "b", "é", "漢", "\xa0", "#", "|", " ", " ", " ", "\n", "\t", "\x0b", "\x1c"]) for _ in range(random.randint(0, 120)))
        text += " one two three four five six seven eight nine" * random.randint(0, 3)
        assert quality.describe(text.encode())[0] == brute_counts(text), repr(text)


def test_base_limits():
    assert quality.base_failed(19, 0) and not quality.base_failed(20, 6) and quality.base_failed(20, 7)


def test_trees_never_rise_with_constrained_features():
    random = np.random.default_rng(3)
    x = random.random((3000, len(quality.FEATURES)))
    y = (random.random(3000) < 0.5 + 0.4 * np.sin(9 * x[:, 2]) * (x[:, 5] > 0.3)).astype(float)
    model = quality.QualityModel.train(x, y)
    for name in quality.FALLING:
        f = quality.FEATURES.index(name)
        probe = np.repeat(random.random((200, x.shape[1])), 30, axis=0)
        probe[:, f] = np.tile(np.linspace(0, 1, 30), 200)
        assert (np.diff(model.score(probe).reshape(200, 30), axis=1) <= 1e-12).all()


def test_trees_learn_what_is_there():
    random = np.random.default_rng(4)
    x = random.random((4000, len(quality.FEATURES)))
    y = ((x[:, 1] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality.QualityModel.train(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.95


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (999, 0)], "doc_id long, quality int")
    model = quality.fit(awkward, labels)
    rows = quality.judge(awkward, model).collect()
    texts = {r["doc_id"]: r["text"] for r in awkward.collect()}
    assert len(rows) == awkward.count()
    for r in rows:
        counts = brute_counts(texts[r["doc_id"]])
        assert [r[c] for c in quality.COUNTS] == counts
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.ACCEPT)
    left = quality.keep(awkward, model)
    assert left.columns == awkward.columns and left.count() == sum(r["kept"] for r in rows)
    assert quality.judge(empty, model).count() == 0 and quality.keep(empty, model).count() == 0
    assert quality.fit(empty, labels).depth == 0


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")]
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    held = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").toPandas()
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert len(good) > 500 and len(bad) > 50
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.05


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_quality"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all([r[c] for c in quality.COUNTS] == brute_counts(texts[r["doc_id"]]) for r in rows)
