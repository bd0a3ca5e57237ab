from __future__ import annotations

from collections import defaultdict

import numpy as np
from test_lines import brute as brute_lines
from test_minhash import brute as brute_groups
from tokenizers import Tokenizer

import corpus_pipeline
from docloom.llm import quality
from docloom.llm.queries import WORD_BPE

SF = "/root/testdata/sf0.001"


def test_stages_against_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == columns
    judged = quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in judged.collect() if r["kept"]}

    thinned = corpus_pipeline.line_dedup(spark, kept, SF)
    assert thinned.columns == columns
    rows = thinned.collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted(
        (d, t) for d, t, _, _ in brute_lines([(r["doc_id"], r["text"]) for r in kept.collect()])
    )
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    single = corpus_pipeline.near_dedup(spark, thinned, SF)
    assert single.columns == columns
    groups = brute_groups({r["doc_id"]: r["text"] for r in rows}, 5)
    left = {r["doc_id"]: r["text"] for r in single.collect()}
    assert set(left) == {i for i, (_, g) in groups.items() if i == g}

    library = Tokenizer.from_file(WORD_BPE)
    held = defaultdict(int)
    for r in corpus_pipeline.best_fit_packing(spark, single, SF).collect():
        held[r["doc_id"]] += r["length"]
    assert held == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}


def test_run_joins_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "best_fit_packing"]
    ends = defaultdict(int)
    for r in rows:
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 4096 and np.mean(list(ends.values())) > 0.9 * 4096


def test_empty_and_awkward_tables(spark, empty, awkward):
    for docs in (empty, awkward):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0
