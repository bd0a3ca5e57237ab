from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import DOCUMENTS

from docloom.llm import collocations as col
from docloom.llm.queries import QUERIES


def brute(rows, least=30, top=2000) -> list[tuple]:
    """``rows``: (text, lang)."""
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        several = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, f in several.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * f >= 80 * several[p[i : i + k]]:
                        dropped.add(p[i : i + k])
        scored = []
        for p, a in several.items():
            if p not in dropped:
                score, _, left, right = min((2000000 * a // (own[p[:j]] + own[p[j:]]), j, own[p[:j]], own[p[j:]]) for j in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df) -> list[tuple]:
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None) for i, (t, lang) in enumerate(rows)], DOCUMENTS)


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_trie_finds_what_a_set_finds(depth):
    random = np.random.default_rng(depth)
    for vocabulary, n in ((3, 2), (40, 300), (3000, 5000)):
        words = random.integers(-(2**62), 2**62, vocabulary)
        phrases = np.unique(words[random.integers(0, vocabulary, (n, depth))], axis=0)
        random.shuffle(phrases)
        trie = col._unpacked(col._packed(col.Trie(phrases)))
        text = np.concatenate([words[random.integers(0, vocabulary, 2000)], phrases[:50].ravel(), [0, 7, int(words[0])]])
        text[::97] = 0
        known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
        expected = [(i, known[tuple(text[i : i + depth].tolist())]) for i in range(len(text) - depth + 1) if tuple(text[i : i + depth].tolist()) in known]
        place, phrase = trie.walk(text)
        assert list(zip(place.tolist(), phrase.tolist())) == expected


def test_slices_cut_no_word():
    texts = [b"One two,three\tfour", b"x" * 50, b"", b"a b c d e f g"]
    for size in (1, 3, 10, 1000):
        parts = list(col.slices(texts, size))
        words = [w for p in parts for w in p.replace(b"\xff", b" \xff ").split()]
        assert words == b"one two \xff three four \xff".split() + [b"x" * 50, b"\xff", b"\xff"] + b"a b c d e f g".split()


@pytest.mark.parametrize("size, tries", [(40, 7), (1 << 20, 400_000)])
def test_against_counting_all_phrases(spark, size, tries):
    random.seed(size)
    words = ["the", "of", "new", "York", "CITY", "Straße", "漢字", "a-b", "\x1c", "x" * 300] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(random.randint(0, 12)):
            parts.append(random.choice(["New York city", "of the", "in the new York", "a b c d e", " ".join(random.choices(words, k=random.randint(1, 6)))]))
        rows.append((random.choice([" ", ", ", "\n", "\t", " ! "]).join(parts), random.choice(["en", "en", "en", "fr", None, "und"])))
    rows += [("New York city " * 3000, "en"), ("same row here now", "de")] + [("same row here now", "de")] * 40 + [(None, "en"), ("", None), (" \t.,", "es")]
    df = table_of(spark, rows).repartition(5)
    assert found(col.collocations(df, size=size, trie_phrases=tries)) == brute(rows)
    assert found(col.collocations(df, size=size, trie_phrases=tries, least=5, top=7)) == brute(rows, 5, 7)


def test_two_words_with_one_code_take_another_seed(spark, monkeypatch):
    rows = [("alpha beta gamma", "en")] * 30
    real = col.encoded
    seeds = []

    def clashing(docs, seed=0, size=col.SLICE):
        seeds.append(seed)
        made = real(docs, seed, size)
        return made if seed else made.selectExpr("lang", "codes", "skip", "words", "transform(own, x -> 5L) AS own", "counts")

    monkeypatch.setattr(col, "encoded", clashing)
    assert found(col.collocations(table_of(spark, rows))) == brute(rows)
    assert seeds == [0, 1]


def test_awkward_rows(awkward, empty):
    rows = [(r["text"], r["lang"]) for r in awkward.collect()]
    assert found(col.collocations(awkward)) == brute(rows)
    assert col.collocations(empty).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(QUERIES["op11_collocations"](spark, sf_dir)) == brute(rows)
