from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from conftest import DOCUMENTS

from docloom.llm import lines

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows) -> list[tuple]:
    """``(doc_id, left, n_lines, n_dropped)`` of every row, in order."""
    key = lambda x: x.strip(WHITE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        if doc_id is not None:
            for x in (text or "").split("\n"):
                holders[key(x)].add(doc_id)
    made = []
    for doc_id, text in rows:
        split = (text or "").split("\n")
        gone = lambda k: doc_id is not None and len(k) >= 10 and len(holders[k]) > 1 and min(holders[k]) != doc_id
        left = [x for x in split if not gone(key(x))]
        made.append((doc_id, "\n".join(left), len(split), len(split) - len(left)))
    return sorted(made, key=str)


def found(docs, **options) -> list[tuple]:
    return sorted((tuple(r) for r in lines.LineDedup(docs, **options).counted().collect()), key=str)


def test_filters_hold_what_two_documents_hold():
    once, twice = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
    a, b = lines._hashed([b"%d" % i for i in range(1000)]), lines._hashed([b"%d" % i for i in range(900, 1900)])
    lines._fold(once, twice, a)
    assert not twice[lines._positions(a, 1 << 16)].all(axis=0).sum() > 40
    lines._fold(once, twice, b)
    assert twice[lines._positions(lines._hashed([b"%d" % i for i in range(900, 1000)]), 1 << 16)].all()
    assert once[lines._positions(np.concatenate([a, b]), 1 << 16)].all()


def test_filter_size_is_bounded():
    assert lines.filter_bits(0) == 1 << 16
    assert lines.filter_bits(10**6) == 1 << 27 == lines.filter_bits(10**12)


def test_random_documents(spark):
    random.seed(4)
    pool = [f"Line number {i} of the pool é{i}" for i in range(60)] + ["short", "", "123456789", "1234567890", "éééééééééé", "ééééééééé"]
    rows = []
    for i in random.sample(range(10_000), 300):
        text = "\n".join(random.choice([str.upper, str, lambda x: f"  {x}\t", lambda x: x + "\r"])(random.choice(pool)) for _ in range(random.randint(0, 6)))
        rows.append((i, text + f"\nand one of its own {i}"))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(9)
    assert found(docs) == brute(rows)
    # A filter far too small suspects every key, the result is the same.
    assert found(docs, max_bits=64) == brute(rows)


def test_awkward_rows(awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    left = lines.LineDedup(awkward).rows()
    assert left.columns == awkward.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == sorted((d or 0, t) for d, t, _, _ in brute(rows))
    assert lines.LineDedup(empty).rows().count() == 0 and lines.LineDedup(empty).counted().count() == 0
