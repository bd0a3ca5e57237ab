from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DOCUMENTS

from docloom.llm import bpe
from docloom.llm.queries import BYTE_BPE, QUERIES

PATTERN = public_tokenizers.PATTERN
BITS = ["a", "b", "the", " ", "  ", "\n", " \n", "\t", "é", "’", "'s", "1", "23", "!!", "\x1c", "\x85", "\xa0", "漢", "😀", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    with open(BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def test_queue_gives_least_rank_and_leftmost_position():
    random.seed(1)
    queue, held = bpe.RankQueue(5000), []
    for _ in range(3000):
        if held and random.random() < 0.45:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            entry = random.randrange(5000) if random.random() < 0.5 else random.randrange(9), random.randrange(100)
            queue.push(*entry)
            held.append(entry)
    while held:
        assert queue.pop() == min(held)
        held.remove(min(held))
    assert not queue.top


def test_random_texts_as_the_library(library):
    random.seed(2)
    codec = bpe.codec(BYTE_BPE, PATTERN)
    for _ in range(5000):
        text = "".join(random.choice(BITS) for _ in range(random.randint(0, 14)))
        assert ids(codec.encode(text)) == library.encode_ordinary(text), repr(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_long_words_as_the_library(library):
    random.seed(3)
    codec = bpe.codec(BYTE_BPE, PATTERN)
    for letters in ("a", "ab", "ethrnisox"):
        text = "".join(random.choice(letters) for _ in range(20_000))
        assert ids(codec.encode(text)) == library.encode_ordinary(text)


def test_other_pattern_goes_without_shortcuts():
    codec = bpe.BytePairCodec({bytes([i]): i for i in range(256)} | {b" a": 256}, r"\s|\S+")
    assert ids(codec.encode("b a")) == [98, 32, 97]


def test_words_fall_out_of_the_cache(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    codec = bpe.BytePairCodec(library._mergeable_ranks, PATTERN)
    text = "many different words are in this text and then many different words again"
    assert ids(codec.encode(text)) == library.encode_ordinary(text)


def test_awkward_rows(spark, awkward, library):
    rows = bpe.round_trip(awkward, BYTE_BPE, PATTERN).collect()
    encoded = bpe.encode(awkward, BYTE_BPE, PATTERN)
    assert sorted(bytes(r["ids"]) for r in encoded.collect()) == sorted(bytes(r["ids"]) for r in rows)
    decoded = bpe.decode(encoded, BYTE_BPE, PATTERN)
    assert sorted(bytes(r["bytes"]) for r in decoded.collect()) == sorted(bytes(r["bytes"]) for r in rows)
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    assert len(rows) == awkward.count()
    for r in rows:
        assert ids(r["ids"]) == library.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["bytes"]) == texts[r["doc_id"]].encode()


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(spark.createDataFrame([], DOCUMENTS), BYTE_BPE, PATTERN), BYTE_BPE, PATTERN).count() == 0


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(expected)
        assert r["ids_sha256"] == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
