"""Approximate nearest neighbours by learned partitions.

Fitting takes at most ``sample`` usable vectors, those least by the hash of their id. Their graph of nearest
neighbours is cut into partitions of equal size with few edges between them: halves along principal
directions, then moves of vertices to the partition of most of their neighbours while sizes stay
balanced. A small network learns, from a vector, in which partitions its neighbours lie. It indexes every row
by its most probable partition, and routes a query to as many of the most probable partitions as the
neighbours of held-out vectors of the sample needed for the recall that is asked for.

Candidates and queries of a partition meet in blocks of bounded size, dealt by hash, so a partition or a
vector that holds a third of all rows is searched by many tasks. Scores are sums of products in double
precision over the original vectors, added up in the order of the dimensions, so equal vectors have equal scores. Each
block gives the best of its rows to the query, and these are merged.

Defined cases: vectors that are null, zero, of another length than the table's, or hold null or
non-finite components take no part, as queries or as candidates; nor do rows with a null id. The length is the
most frequent one of all usable vectors, the smallest among equals. A sample of fewer than 128 makes one partition. Equal scores are
ordered by id. Repeated rows are candidates as often as they occur, but never of their own id. A query whose
partitions hold too few candidates is routed to further ones, so it gets ``k`` if the table has them. Only the two
named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import narrow
from docloom.session import materialize

SAMPLE = 10_000
PARTITIONS = 32
RECALL = 0.97
ROWS_PER_BLOCK = 1024
QUERIES_PER_BLOCK = 2048

_GRAPH = 16  # neighbours of a vertex
_HIDDEN = 96
_SLICE = 128


def _nearest(vectors: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the ``k`` largest inner products with each of ``queries``, which are row numbers."""
    found = np.empty((len(queries), k), np.int64)
    for begin in range(0, len(queries), 512):
        own = queries[begin : begin + 512]
        scores = vectors[own] @ vectors.T
        scores[np.arange(len(own)), own] = -np.inf
        found[begin : begin + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return found


def _halves(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of equal size: halves along the direction of largest variance, again and again."""
    label = np.zeros(len(vectors), np.int64)
    waiting = [(np.arange(len(vectors)), 0, parts)]
    while waiting:
        rows, first, count = waiting.pop()
        if count == 1:
            label[rows] = first
            continue
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        ordered = rows[np.argsort(centred @ direction, kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        waiting += [(ordered[:cut], first, left), (ordered[cut:], first + left, count - left)]
    return label


def partition_graph(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 10, slack: float = 0.1) -> np.ndarray:
    """A balanced partition of the vertices with few edges of ``graph`` (a row of neighbours each) cut."""
    label = _halves(vectors, parts)
    n = len(vectors)
    most, least = int(np.ceil(n / parts * (1 + slack))), int(n / parts * (1 - slack))
    sizes = np.bincount(label, minlength=parts)
    source = np.repeat(np.arange(n), graph.shape[1])
    target = graph.ravel()
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    for _ in range(rounds):
        votes = np.bincount(source * parts + label[target], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            old, new = label[v], best[v]
            if sizes[new] < most and sizes[old] > least:
                label[v] = new
                sizes[old] -= 1
                sizes[new] += 1
                moved += 1
        if moved < n // 1000 + 1:
            break
    return label


@dataclass(frozen=True)
class Router:
    """A network of one hidden layer from vectors to partitions."""

    mean: np.ndarray
    scale: float
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    d: np.ndarray
    probes: int

    @property
    def partitions(self) -> int:
        return len(self.d)

    def _scaled(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.mean) * self.scale

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        out = np.maximum(self._scaled(vectors) @ self.a + self.b, 0) @ self.c + self.d
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    @staticmethod
    def fit(vectors: np.ndarray, parts: int = PARTITIONS, recall: float = RECALL, k: int = 20, epochs: int = 25, seed: int = 7) -> Router:
        """Cut the neighbour graph of ``vectors``, learn the partitions, choose the number of probes."""
        n, dim = vectors.shape
        parts = max(1, min(parts, n // 64))
        mean = vectors.mean(axis=0)
        scale = 1.0 / max(float(vectors.std()), 1e-12)
        if parts == 1:
            return Router(mean, scale, np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
        graph = _nearest(vectors, np.arange(n), min(_GRAPH, n - 1))
        label = partition_graph(vectors, graph, parts)
        wanted = np.zeros((n, parts))
        np.add.at(wanted, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1.0)
        wanted[np.arange(n), label] += graph.shape[1] / 2
        wanted /= wanted.sum(axis=1, keepdims=True)
        random = np.random.default_rng(seed)
        order = random.permutation(n)
        held, learn = order[: n // 5], order[n // 5 :]
        weights = [
            random.normal(0, (2 / dim) ** 0.5, (dim, _HIDDEN)), np.zeros(_HIDDEN),
            random.normal(0, (1 / _HIDDEN) ** 0.5, (_HIDDEN, parts)), np.zeros(parts),
        ]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        x = (vectors - mean) * scale
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs) + 1e-4
            for rows in np.array_split(random.permutation(learn), max(1, len(learn) // 128)):
                hidden = np.maximum(x[rows] @ weights[0] + weights[1], 0)
                out = hidden @ weights[2] + weights[3]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                error = (out / out.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
                back = (error @ weights[2].T) * (hidden > 0)
                step += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        router = Router(mean, scale, *weights, parts)
        # Rows are indexed by the network, so held-out neighbours are looked for where it puts them.
        placed = router.probabilities(vectors)
        ranks = np.argsort(np.argsort(-placed[held], axis=1), axis=1)
        near = placed.argmax(axis=1)[_nearest(vectors, held, min(k, n - 1))]
        needed = np.sort(np.take_along_axis(ranks, near, axis=1).ravel()) + 1
        return Router(mean, scale, *weights, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]))


def _matrix(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors of a list column as rows of a matrix, and which rows of the column they are."""
    lists = column.cast(pa.list_(pa.float64()))
    lengths = np.nan_to_num(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), float), nan=-1).astype(np.int64)
    if dim is None:
        found, counts = np.unique(lengths[lengths > 0], return_counts=True)
        if not len(found):
            return np.zeros((0, 0)), np.zeros(0, np.int64)
        dim = int(found[np.argmax(counts)])
    rows = np.flatnonzero(lengths == dim)
    if not len(rows) or not dim:
        return np.zeros((0, dim)), np.zeros(0, np.int64)
    flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)  # null components are read as nan
    return flat[good], rows[good]


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows for each query: numbers of queries, ids and scores."""
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], np.ascontiguousarray(vectors[order].T)
    which, found, values = [], [], []
    for begin in range(0, len(queries), _SLICE):
        part = queries[begin : begin + _SLICE]
        scores = np.zeros((len(part), len(ids)))
        for d in range(columns.shape[0]):
            scores += part[:, d : d + 1] * columns[d]
        scores[query_ids[begin : begin + _SLICE, None] == ids] = -np.inf
        top = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # equal scores stay in the order of ids
        value = np.take_along_axis(scores, top, axis=1)
        row, place = np.nonzero(value > -np.inf)
        which.append(begin + row)
        found.append(ids[top[row, place]])
        values.append(value[row, place])
    return np.concatenate(which), np.concatenate(found), np.concatenate(values)


def fit(vectors: DataFrame, sample: int = SAMPLE, partitions: int = PARTITIONS, recall: float = RECALL, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> Router | None:
    """Learn partitions from at most ``sample`` vectors; None without a usable vector."""
    values = F.col("vector").cast("array<double>")
    finite = F.forall(values, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # nan is above infinity
    usable = finite & F.exists(values, lambda x: x != 0)
    rows = narrow(vectors, vec_id=key, vector=vector).dropna().where(usable)
    # Rows that cannot be used go before the sample is drawn, so they never take its places.
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "dim").first()
    if usual is None:
        return None
    chosen = rows.where(F.size("vector") == usual["dim"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    matrix, _ = _matrix(chosen.column("vector").combine_chunks(), usual["dim"])
    return Router.fit(matrix, partitions, recall, k) if len(matrix) > 1 else None


def search(vectors: DataFrame, is_query, router: Router | None, k: int = 20, rows_per_block: int = ROWS_PER_BLOCK,
           queries_per_block: int = QUERIES_PER_BLOCK, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row with ``is_query``, a Column over ``vec_id``."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[key]
    if router is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    dim, partitions, probes = len(router.mean), router.partitions, router.probes
    rows = narrow(vectors, vec_id=key, vector=vector).where("vec_id is not null").withColumn("is_query", is_query)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, at = _matrix(batch.column("vector"), dim)
            order = np.argsort(-router.probabilities(matrix), axis=1, kind="stable").astype(np.int32)
            kept = batch.take(pa.array(at))
            asks = kept.column("is_query").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column("vec_id"),
                    pa.array(list(matrix), pa.list_(pa.float64())),
                    pa.array(order[:, 0] if len(order) else [], pa.int32()),
                    pa.array([o if q else None for o, q in zip(order, asks)], pa.list_(pa.int32())),
                ],
                ["vec_id", "vector", "partition", "route"],
            )

    placed = rows.mapInArrow(place, f"vec_id {kind}, vector array<double>, partition int, route array<int>")
    placed = materialize(placed, "placed")

    # As many rows as there are partitions.
    held = {r["partition"]: r["n"] for r in placed.groupBy("partition").agg(F.count("*").alias("n")).collect()}
    sizes = F.array(*[F.lit(int(held.get(p, 0))) for p in range(partitions)])
    # Partitions before the first ``probes`` and before there are k candidates besides the query's own row.
    before = F.transform(
        F.col("route"), lambda p, i: F.aggregate(F.slice("route", 1, i), F.lit(0).cast("long"), lambda s, q: s + F.get(sizes, q))
    )
    routed = placed.where("route is not null").select(F.col("vec_id").alias("query_id"), "vector", F.arrays_zip("route", before.alias("before")).alias("way"))
    routed = routed.select("query_id", "vector", F.posexplode("way").alias("step", "to"))
    routed = routed.where((F.col("step") < probes) | (F.col("to.before") < 2 * k + 1)).select("query_id", "vector", F.col("to.route").alias("partition"))

    # Both sides are cut into blocks; every pair of blocks of a partition is searched by itself.
    asked = {r["partition"]: r["n"] for r in routed.groupBy("partition").agg(F.count("*").alias("n")).collect()}
    row_blocks = F.array(*[F.lit(max(1, -(-held.get(p, 0) // rows_per_block))) for p in range(partitions)])
    query_blocks = F.array(*[F.lit(max(1, -(-asked.get(p, 0) // queries_per_block))) for p in range(partitions)])

    def dealt(df: DataFrame, id_name: str, own: str, own_blocks, other: str, other_blocks) -> DataFrame:
        mine = F.pmod(F.xxhash64(id_name), F.get(own_blocks, F.col("partition")).cast("long")).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.get(other_blocks, F.col("partition")) - 1))
        return df.select(id_name, "vector", "partition", mine.alias(own), others.alias(other))

    left = dealt(placed.select("vec_id", "vector", "partition"), "vec_id", "r", row_blocks, "q", query_blocks)
    right = dealt(routed, "query_id", "q", query_blocks, "r", row_blocks)

    def block(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        ids, asks = candidates.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        if not len(ids) or not len(asks):
            return pa.table({"query_id": queries.column("query_id").slice(0, 0), "vec_id": candidates.column("vec_id").slice(0, 0), "score": pa.array([], pa.float64())})
        x, q = [t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) for t in (candidates, queries)]
        which, found, scores = best(q, asks, x, ids, k)
        return pa.table({"query_id": asks[which], "vec_id": found, "score": scores})

    found = (
        left.groupBy("partition", "r", "q")
        .cogroup(right.groupBy("partition", "r", "q"))
        .applyInArrow(block, f"query_id {kind}, vec_id {kind}, score double")
    )
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
