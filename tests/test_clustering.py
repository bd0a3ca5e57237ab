from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from docloom.operators import clustering as C
from docloom.operators.words import tokenize


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    topics = [[f"t{t}w{i}" for i in range(12)] for t in range(4)]
    rows = [(f"/{i}", " ".join(rng.choice(topics[i % 4]) for _ in range(40))) for i in range(80)]
    return spark.createDataFrame(rows, "path string, body string").cache()


def test_hashed_counts_add_up_to_the_words(spark, docs):
    counted = C.hashing_tf().transform(tokenize(docs))
    total = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, b: a + b)
    assert all(n == t for n, t in counted.select(F.size("words"), total).collect())


def test_top_terms_of_given_clusters(spark):
    rows = [("/a", "red red sun"), ("/b", "red sun all"), ("/c", "sea all"), ("/d", ""), ("/e", None), ("/f", "sea far")]
    words = tokenize(spark.createDataFrame(rows, "path string, body string"))
    labels = spark.createDataFrame([("/a", 1), ("/b", 1), ("/c", 2), ("/d", 3), ("/x", 4)], "path string, cluster int")
    found = [tuple(r) for r in C.top_terms(words, labels, 2).orderBy("cluster", "rank").collect()]
    one = round(float(np.log(7 / 3)), 6)
    assert found == [(1, 1, "red", 3, round(3 * float(np.log(7 / 3)), 6)), (1, 2, "sun", 2, round(2 * float(np.log(7 / 3)), 6)),
                     (2, 1, "all", 1, one), (2, 2, "sea", 1, one)]
    assert C.top_terms(words.limit(0), labels).count() == 0


def test_every_document_gets_one_cluster(spark, docs):
    model = C.fit_clusters(docs, k=4)
    found = C.assign(model, docs)
    assert found.dtypes == [("path", "string"), ("cluster", "int")]
    rows = {r["path"]: r["cluster"] for r in found.collect()}
    assert len(rows) == 80 == found.count()
    assert set(rows.values()) <= set(range(4))
    sizes = {r["cluster"]: r["documents"] for r in C.cluster_sizes(found).collect()}
    assert sum(sizes.values()) == 80
    again = {r["path"]: r["cluster"] for r in C.assign(C.fit_clusters(docs, k=4), docs).collect()}
    assert again == rows
    # One topic is never torn apart more than k-means may: same words, mostly same cluster.
    assert model.stages[-1].summary is None or model.stages[-1].summary.trainingCost > 0


def test_cost_falls_with_more_clusters(docs):
    costs = [C.fit_clusters(docs, k=k).stages[-1].summary.trainingCost for k in (2, 4, 8)]
    assert costs == sorted(costs, reverse=True)


def test_a_saved_model_scores_new_text(spark, docs, tmp_path):
    model = C.fit_clusters(docs, k=3, ngrams=(2, 3), normalize=True)
    C.save_model(model, str(tmp_path / "m"))
    C.save_model(model, str(tmp_path / "m"))
    loaded = C.load_model(str(tmp_path / "m"))
    new = spark.createDataFrame([("/n", "t0w1 t0w2 it's"), ("/e", ""), ("/z", None)], "path string, body string")
    assert sorted(map(tuple, C.assign(loaded, new).collect())) == sorted(map(tuple, C.assign(model, new).collect()))
    assert C.assign(loaded, new).count() == 3


def test_word_stage_cuts_as_the_tokenizer_does(spark):
    df = spark.createDataFrame([("/a", "l'été 3.14 d’un x_y"), ("/b", "one"), ("/c", None)], "path string, body string")
    for ngrams in ((), (2, 3)):
        staged = C.word_stage(ngrams).transform(df).select("path", "words").collect()
        assert sorted(staged) == sorted(tokenize(df, ngrams).collect())


def test_centers(spark, docs):
    model = C.fit_clusters(docs, k=3, num_features=50)
    rows = C.centers(model, docs).collect()
    assert len(rows) == 150
    expected = model.stages[-1].clusterCenters()
    assert all(expected[r["cluster"]][r["dim"]] == r["weight"] for r in rows)


def test_nearest_center_against_a_loop(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=6).tolist(), i % 3) for i in range(60)]
    df = spark.createDataFrame(vectors, "id int, v array<double>, label int")
    means = C.mean_centers(df, "v", "label")
    points = {r["cluster"]: np.array(r["center"]) for r in means.collect()}
    for label, point in points.items():
        assert np.allclose(point, np.mean([v for _, v, l in vectors if l == label], axis=0))
    found = {r["id"]: r["c"] for r in df.select("id", C.nearest_center(F.col("v"), means).alias("c")).collect()}
    for i, v, _ in vectors:
        assert found[i] == min(points, key=lambda c: (((np.array(v) - points[c]) ** 2).sum(), c))


def test_coordinates_do_not_move_for_the_check(spark, plan):
    docs = spark.createDataFrame([(f"/{i}", f"{'cat dog' if i % 2 else 'red blue'} w{i % 3}") for i in range(40)], "path string, body string")
    model, clusters = C.fit_assign(docs, k=2, num_features=50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(C.is_nearest(model, docs, clusters))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for part in text.split("Exchange\n")[1:] for line in part.splitlines()[:1]]
    assert moved and not any("features" in line or "x#" in line for line in moved)
    wrong = clusters.withColumn("cluster", F.when(F.col("path") == "/0", 1 - F.col("cluster")).when(F.col("path") == "/1", 7).otherwise(F.col("cluster")))
    assert {r["path"] for r in C.is_nearest(model, docs, wrong).collect() if not r["nearest"]} == {"/0", "/1"}


def test_the_fit_keeps_nothing_in_memory(spark, docs, monkeypatch):
    """Kept features took all memory that an executor had; a task's part of them is bounded."""
    seen = []

    def fit(self, dataset, params=None, own=C.KMeans.fit):
        seen.append((dataset.storageLevel, spark.conf.get("spark.sql.files.maxPartitionBytes")))
        return own(self, dataset)

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(C.KMeans, "fit", fit)
    C.fit_clusters(docs, k=2)
    [(level, part)] = seen
    assert level.useDisk and not level.useMemory
    assert part == str(C.PART_BYTES) and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
