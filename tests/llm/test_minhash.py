from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import DOCUMENTS

from docloom.llm import minhash
from docloom.llm.components import components
from docloom.llm.queries import QUERIES


def brute(texts: dict[int, str | None], size: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    """``{doc_id: (n_shingles, component_id)}`` from all pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and percent * max(len(x), len(y)) <= 100 * min(len(x), len(y)):
                if 100 * len(x & y) >= percent * len(x | y):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(df) -> dict[int, tuple[int, int]]:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], DOCUMENTS)


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(3000)] + [(i, i + 2) for i in range(10_000, 10_400, 2)] + [(7777, 7777)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    expected = {i: 0 for i in range(3001)} | {i: 10_000 for i in range(10_000, 10_402, 2)}
    assert {r["id"]: r["component"] for r in rows} == expected


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_has_no_empty_bin_and_is_the_same_for_equal_sets():
    sketcher = minhash.Sketcher(42, 6)
    one = minhash.shingles(b"a b", 5)
    assert len(one) == 1 and len(set(sketcher.keys(one).tolist())) == 42
    again = minhash.Sketcher(42, 6).keys(minhash.shingles(b"A\tB ", 5))
    assert (again == sketcher.keys(one)).all()


def test_bins_agree_as_often_as_the_sets_are_alike():
    random.seed(5)
    agree, sketcher = [], minhash.Sketcher(200, 1)
    for _ in range(30):
        words = [str(random.random()) for _ in range(60)]
        x, y = minhash.shingles(" ".join(words[:50]).encode(), 1), minhash.shingles(" ".join(words[10:]).encode(), 1)
        agree.append((sketcher.keys(x) == sketcher.keys(y)).mean())
    assert abs(np.mean(agree) - 40 / 60) < 0.03


@pytest.mark.parametrize("size", [2, 5])
def test_chains_stars_and_copies(spark, size):
    """Families in which members are like their neighbours and unlike the centre of a star."""
    random.seed(size)
    texts, n = {}, 0
    for _ in range(6):
        words = [random.choice("abcdefghijklmnop") + str(random.randrange(50)) for _ in range(80)]
        for _ in range(12):
            words = list(words)
            for _ in range(random.randint(0, 4)):
                words[random.randrange(len(words))] = str(random.randrange(10**6))
            texts[n * 7 % 1009] = " ".join(words)
            n += 1
    for i in range(40):
        texts[2000 + i] = texts[i * 7 % 1009 if i < 10 else 0]
    random_order = list(texts.items())
    random.shuffle(random_order)
    texts = dict(random_order)
    assert found(minhash.near_duplicates(docs_of(spark, texts), size=size)) == brute(texts, size)


def test_awkward_rows(awkward, empty):
    rows = minhash.near_duplicates(awkward, size=2).collect()
    texts = {r["doc_id"]: r["text"] for r in awkward.collect() if r["doc_id"] is not None}
    expected = brute(texts, 2)
    assert len(rows) == awkward.count()
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert expected[7][1] == 6 and expected[13][1] == 12
    left = minhash.keep_one(awkward)
    assert left.columns == awkward.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9, 9, 12]
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert found(QUERIES["op3_minhash"](spark, sf_dir)) == brute(texts, 2)
