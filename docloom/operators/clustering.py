"""Document clusters: hashed word counts, IDF weights, k-means."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer, SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.text import words_sql
from docloom.operators.words import doc_freq, idf
from docloom.session import materialize, settings

# Fixed values of the recipe.
NUM_FEATURES = 1000
CLUSTERS = 20
MAX_ITER = 40
SEED = 42

# Distances held at a time while the nearest centre is looked for.
_DISTANCES = 4_000_000

# Fixed value: bytes of written counts that a task of the fit reads, and so bounds its cached part.
PART_BYTES = 8 << 20


def word_stage(ngrams: Sequence[int] = ()) -> Transformer:
    """Adds ``words``. Being SQL text, it is saved with the pipeline and runs in the JVM."""
    inner = f"SELECT *, {words_sql('body')} AS words FROM __THIS__"
    if not ngrams:
        return SQLTransformer(statement=inner)
    runs = [
        f"CASE WHEN size(words) >= {n} THEN transform(sequence(1, size(words) - {n - 1}),"
        f" i -> array_join(slice(words, i, {n}), ' ')) ELSE cast(array() as array<string>) END"
        for n in ngrams
    ]
    return SQLTransformer(
        statement=f"SELECT * EXCEPT (words), concat(words, {', '.join(runs)}) AS words FROM ({inner})"
    )


def hashing_tf(num_features: int = NUM_FEATURES) -> HashingTF:
    return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features)


def feature_stages(
    num_features: int = NUM_FEATURES, ngrams: Sequence[int] = (), normalize: bool = False
) -> list:
    """Words, counts, IDF weights in ``features``, on request scaled to unit length."""
    weighted = "weighted" if normalize else "features"
    stages = [word_stage(ngrams), hashing_tf(num_features), IDF(inputCol="rawFeatures", outputCol=weighted)]
    return stages + [Normalizer(inputCol=weighted, outputCol="features")] if normalize else stages


def fit_clusters(
    docs: DataFrame,
    k: int = CLUSTERS,
    max_iter: int = MAX_ITER,
    seed: int = SEED,
    num_features: int = NUM_FEATURES,
    ngrams: Sequence[int] = (),
    normalize: bool = False,
) -> PipelineModel:
    """Fit on ``(path, body)``. The result scores new text, as it includes the IDF weights."""
    return _fitted(docs, k, max_iter, seed, num_features, ngrams, normalize)[0]


def fit_assign(docs: DataFrame, **options) -> tuple[PipelineModel, DataFrame]:
    """``fit_clusters`` and ``(path, cluster)`` of the documents it was fitted on, their words cut once."""
    model, counted = _fitted(docs, **options)
    scored = PipelineModel(stages=model.stages[2:]).transform(counted)
    return model, scored.select("path", F.col("prediction").cast("int").alias("cluster"))


def _fitted(
    docs: DataFrame,
    k: int = CLUSTERS,
    max_iter: int = MAX_ITER,
    seed: int = SEED,
    num_features: int = NUM_FEATURES,
    ngrams: Sequence[int] = (),
    normalize: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """The model and the written table ``(path, rawFeatures)`` of hashed counts it was fitted on.

    Weights, iterations and assignments all start from that table, so texts are read once. What the iterations
    read again is kept on the executors' disks in small parts: a task holds a few rows of it, and memory does not
    grow with the documents. The table can make lost parts again.
    """
    words, counts, *weigh = feature_stages(num_features, ngrams, normalize)
    hashed = PipelineModel(stages=[words, counts]).transform(docs.select("path", "body"))
    # Row groups no larger than a part: a task reads whole ones.
    counted = materialize(hashed.select("path", "rawFeatures"), "counts", **{"parquet.block.size": PART_BYTES})
    with settings(docs.sparkSession, {"spark.sql.files.maxPartitionBytes": str(PART_BYTES)}):
        weights = Pipeline(stages=weigh).fit(counted)
        ready = weights.transform(counted).select("features").persist(StorageLevel.DISK_ONLY)
        try:
            means = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features", predictionCol="prediction").fit(ready)
        finally:
            ready.unpersist()
    return PipelineModel(stages=[words, counts, *weights.stages, means]), counted


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def assign(model: PipelineModel, docs: DataFrame) -> DataFrame:
    """``(path, cluster)`` for every document."""
    scored = model.transform(docs.select("path", "body"))
    return scored.select("path", F.col("prediction").cast("int").alias("cluster"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("documents"))


def centers(model: PipelineModel, docs: DataFrame) -> DataFrame:
    """``(cluster, dim, weight)``, every coordinate of every centre: k times the feature count."""
    found = model.stages[-1].clusterCenters()
    wide = docs.sparkSession.createDataFrame(
        [(i, center.tolist()) for i, center in enumerate(found)], "cluster int, center array<double>"
    )
    return wide.select("cluster", F.posexplode("center").alias("dim", "weight"))


def top_terms(words: DataFrame, clusters: DataFrame, n: int = 10) -> DataFrame:
    """``(cluster, rank, w, c, weight)``: the ``n`` words of the largest TF-IDF sum in each cluster.

    Takes ``(path, words)`` and ``(path, cluster)``. The sum over a cluster is the word's count ``c``
    there times its IDF over all documents, so counts are added as integers, partly before the
    shuffle, and a word meets its IDF once a cluster. Weights are compared to six places, equal
    ones in the order of the words. The rank filter cuts each task's words before they move.
    """
    documents = words.agg(F.count(F.lit(1))).scalar()
    own = T.each(words.join(clusters.select("path", "cluster"), "path"), "words", "cluster", name="w")
    counts = own.groupBy("cluster", "w").agg(F.count(F.lit(1)).alias("c"))
    weights = counts.join(idf(doc_freq(words), documents), "w")
    weights = weights.select("cluster", "w", "c", F.round(F.col("c") * F.col("idf"), 6).alias("weight"))
    order = Window.partitionBy("cluster").orderBy(F.desc("weight"), "w")
    ranked = weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select("cluster", "rank", "w", "c", "weight")


def mean_centers(vectors: DataFrame, vector: str, label: str) -> DataFrame:
    """``(cluster, center)``: the mean vector of each label."""
    dense = vectors.select(F.col(label).alias("cluster"), array_to_vector(F.col(vector).cast("array<double>")).alias("x"))
    means = dense.groupBy("cluster").agg(Summarizer.mean(F.col("x")).alias("center"))
    return means.select("cluster", vector_to_array("center").alias("center"))


def nearest_center(vector: Column, center_table: DataFrame) -> Column:
    """The cluster whose centre is nearest to a dense vector, the lowest number among equals.

    The centres are the model, one row per cluster: sent to each executor once, as a fitted
    k-means model sends its own. Distances are made for some rows at a time, so memory does not
    depend on how many centres there are.
    """
    table = center_table.select("cluster", "center").orderBy("cluster").toPandas()
    names = table["cluster"].to_numpy(np.int32)
    points = np.stack(table["center"].to_numpy()) if len(table) else np.zeros((0, 0))
    model = center_table.sparkSession.sparkContext.broadcast((names, points, (points**2).sum(axis=1)))

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        names, points, norms = model.value
        step = max(1, _DISTANCES // max(len(names), 1))
        best = [
            np.argmin(norms - 2.0 * (np.stack(part.to_numpy()).astype(np.float64) @ points.T), axis=1)
            for part in (vectors.iloc[i : i + step] for i in range(0, len(vectors), step))
        ]
        return pd.Series(names[np.concatenate(best)] if best else [], dtype="int32")

    return nearest(vector)


def is_nearest(model: PipelineModel, docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(path, nearest)``: whether no centre is nearer to a document than that of its cluster.

    Distances are sums over the coordinates, worked out apart from the fitted model's own rule, where the words are
    cut: the nearest clusters of a document, mostly one, go to the join instead of its coordinates.
    """
    points = np.stack(model.stages[-1].clusterCenters())
    features = PipelineModel(stages=model.stages[:-1]).transform(docs.select("path", "body"))

    @F.pandas_udf("array<int>")
    def nearest(x: pd.Series) -> pd.Series:
        found = []
        for vector in x:
            distances = ((points - np.asarray(vector)) ** 2).sum(axis=1)
            found.append(np.flatnonzero(distances <= distances.min() * (1 + 1e-9) + 1e-9).astype(np.int32))
        return pd.Series(found)

    rows = features.select("path", nearest(vector_to_array("features")).alias("_nearest")).join(clusters, "path")
    return rows.select("path", F.coalesce(F.array_contains("_nearest", F.col("cluster")), F.lit(False)).alias("nearest"))
