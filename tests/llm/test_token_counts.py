from __future__ import annotations

import random

import pytest
from conftest import LONG
from tokenizers import Tokenizer, models, pre_tokenizers

from docloom.llm import token_counts
from docloom.llm.queries import PIECES, QUERIES


def library(vocabulary):
    made = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    made.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always", split=True)
    return made


@pytest.fixture(scope="module")
def tokenizer():
    return library(token_counts.vocabulary(PIECES))


def test_random_texts_as_the_library(tokenizer):
    random.seed(1)
    counter = token_counts.counter(PIECES)
    bits = ["a", "the", " ", "  ", "\n", "é", "’", "'s", "1", "23", "漢", "😀", "<s>", "<0x0A>", "▁", "ing", "tion", "\x00"]
    for _ in range(5000):
        text = "".join(random.choice(bits) for _ in range(random.randint(0, 14)))
        assert counter.count(text)[0] == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_ties_as_the_library():
    """Scores so coarse that most splits tie; the number of tokens shows which one is taken."""
    random.seed(2)
    letters = "abc"
    for _ in range(60):
        pieces = {"<unk>": 0.0} | {"<0x%02X>" % i: -50.0 for i in range(256)}
        for _ in range(25):
            pieces["".join(random.choice(letters + "▁") for _ in range(random.randint(1, 4)))] = -float(random.randint(1, 3))
        pieces = {p: s for p, s in pieces.items() if "▁" not in p[1:]}
        made, counter = library(list(pieces.items())), token_counts.UnigramCounter(list(pieces.items()))
        for _ in range(60):
            text = "".join(random.choice(letters + " d") for _ in range(random.randint(1, 12)))
            assert counter.count(text)[0] == len(made.encode(text, add_special_tokens=False).ids), (text, pieces)


def test_awkward_rows(awkward, empty, tokenizer):
    rows = token_counts.token_counts(awkward, PIECES).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    assert len(rows) == awkward.count()
    for r in rows:
        if texts[r["doc_id"]] in (LONG, LONG + "tail"):
            continue
        assert r["n_tokens"] == len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
    assert token_counts.token_counts(empty, PIECES).count() == 0


def test_query(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op2_token_counts"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
        i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()
    }
