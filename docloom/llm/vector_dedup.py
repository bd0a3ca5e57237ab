"""Near-duplicate vectors by searches of robust-pruned graphs built over overlapping shards.

Vectors are compared only within a group: equal labels and lengths.

1. Equal vectors of a group are one class. A tree of clusters is grown level by level: each node with more than
   ``shard_rows`` rows is cut by centres learned from a bounded sample of it, and its rows go to the nearest centre. A row
   goes into the second-nearest as well, as a copy, so shards overlap.
2. In every node, before it is cut, dense spots of the sample become balls: the node's rows that are linked with a pivot. They
   are counted against each other in blocks, which give counts and not pairs, and only the pivot goes further down. A
   family of near copies with a third of all rows ends in one ball instead of filling a shard.
3. In each shard every row gets a robust-pruned list of neighbours: the nearest first, and none that is much nearer
   to a neighbour taken already. Lists of a row from all its shards are united.
4. All rows of a shard search the united graph at once, greedily from medoids and their own list with a beam; where rows in range
   are found the search goes on from each of them until there are no new ones. A ball's range is wider by
   its radius, the angle of a link.
5. Pairs of single vectors in range are links, by the cosine of the vectors themselves. The members of a ball, and those of two
   units that are near each other of which one is a ball, are verified block by block. That is the work of all their
   pairs, as their exact counts demand, dealt over tasks of bounded size.
6. The links of up to ``audit_rows`` vectors, those least by the hash of their id, are counted by brute force over all rows. While the graph
   has found less than ``recall`` of them, the search is done again with twice the beam.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without a label, are linked with nothing,
as are those with a null id, which keep a null component. Equal vectors are linked. Repeated rows are rows of their own with
one id: they link with each other as equal vectors do. Only the three named columns are read. An empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import narrow
from docloom.llm.components import components
from docloom.session import materialize

COSINE = 0.98
SHARD_ROWS = 400
BRANCH = 64
SAMPLE = 1024  # rows of a node from which centres and pivots are taken
DENSE = 16  # rows of the sample near a pivot
BLOCK = 1024
DEGREE = 20
POOL = 48
SLACK = 1.2
BEAM = 16
AUDIT = 256
RECALL = 0.95
ATTEMPTS = 4


def _matrix(column) -> np.ndarray:
    """Vectors of one length, kept as bytes, as rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1) if values else np.zeros((0, 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def usable(rows: DataFrame) -> DataFrame:
    """``(vec_id, grp, vector)`` of the rows ``(vec_id, label, vector)`` that can be linked; ``vector`` are doubles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, groups, vectors = [], [], []
            for vec_id, label, values in zip(*[batch.column(c).to_pylist() for c in ("vec_id", "label", "vector")]):
                if vec_id is None or label is None or not values or None in values:
                    continue
                vector = np.asarray(values, np.float64) + 0.0  # no negative zero
                if np.isfinite(vector).all() and vector.any():
                    ids.append(vec_id)
                    groups.append(f"{len(vector)}:{label}")
                    vectors.append(vector.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(groups, pa.string()), pa.array(vectors, pa.binary())], ["vec_id", "grp", "vector"])

    return rows.mapInArrow(run, "vec_id long, grp string, vector binary")


def pivots_of(unit: np.ndarray, near: float, dense: int) -> np.ndarray:
    """Rows with at least ``dense`` others within ``near``, those with most first, none near another."""
    close = unit @ unit.T >= near
    degree, chosen = close.sum(axis=1) - 1, []
    free = np.ones(len(unit), bool)
    for row in np.argsort(-degree, kind="stable"):
        if degree[row] < dense:
            break
        if free[row]:
            chosen.append(row)
            free &= ~close[row]
    return np.array(chosen, np.int64)


def centres_of(unit: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``count`` clusters: rows far from each other, then means of the nearest."""
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, unit @ unit[far])
    centres = unit[chosen]
    for _ in range(rounds):
        label = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, unit)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return centres


def robust_pruned(unit: np.ndarray, degree: int = DEGREE, pool: int = POOL, slack: float = SLACK, seed: int = 3) -> np.ndarray:
    """Neighbours of each row, ``-1`` where there are fewer than ``degree``; every step is taken for all rows at once."""
    n = len(unit)
    if n < 2:
        return np.full((n, degree), -1, np.int64)
    distance = np.sqrt(np.maximum(2 - 2 * (unit @ unit.T), 0))
    np.fill_diagonal(distance, np.inf)
    near = np.argpartition(distance, min(pool, n - 1) - 1, axis=1)[:, : min(pool, n - 1)]
    far = np.random.default_rng(seed).integers(0, n, (n, 12))
    tried = np.concatenate([near, far], axis=1)
    tried = np.take_along_axis(tried, np.argsort(np.take_along_axis(distance, tried, axis=1), axis=1, kind="stable"), axis=1)
    own = np.take_along_axis(distance, tried, axis=1)
    np.fill_diagonal(distance, 0)
    alive, rows = np.isfinite(own), np.arange(n)
    taken = np.full((n, degree), -1, np.int64)
    for turn in range(degree):
        some = alive.any(axis=1)
        first = alive.argmax(axis=1)
        pick = tried[rows, first]
        taken[some, turn] = pick[some]
        alive &= slack * distance[pick[:, None], tried] > own
        alive[rows, first] = False
    return taken


def both_ways(graph: np.ndarray, room: int) -> np.ndarray:
    """The lists and, as far as ``room`` goes, the reverse of their edges."""
    n, degree = graph.shape
    source, target = np.repeat(np.arange(n), degree), graph.ravel()
    good = target >= 0
    source, target = source[good], target[good]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    held = place < room
    back = np.full((n, room), -1, np.int64)
    back[target[held], place[held]] = source[held]
    return np.concatenate([graph, back], axis=1)


def range_search(unit: np.ndarray, graph: np.ndarray, reach: np.ndarray, beam: int, entries: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows ``(q, x)``, q before x, where x was found within ``max(reach[q], reach[x])``, cosines, of q.

    All rows search at once: a step looks at the neighbours of the best row not yet looked at of every beam. After that,
    whatever is in range is looked at as well, until no search finds more.
    """
    n = len(unit)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    medoids = [int((unit @ unit.mean(axis=0)).argmax())]
    nearest = unit @ unit[medoids[0]]
    while len(medoids) < min(entries, n):
        medoids.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[medoids[-1]])
    pairs_q, pairs_x = [], []
    for begin in range(0, n, 512):
        q = np.arange(begin, min(n, begin + 512))
        score = np.full((len(q), n), -np.inf)  # of the rows that were met
        looked = np.zeros((len(q), n), bool)
        score[:, medoids] = unit[q] @ unit[medoids].T
        score[np.arange(len(q)), q] = 1.0
        limit = np.minimum(reach[q][:, None], reach[None, :])  # the wider of the two ranges
        who = np.arange(len(q))
        while len(who):
            held = np.where(looked[who], -np.inf, score[who])
            best = held.argmax(axis=1)
            top = held[np.arange(len(who)), best]
            # The beam of a search is full of rows looked at when `beam` of them are better than all others.
            kth = np.partition(score[who], n - min(beam, n), axis=1)[:, n - min(beam, n)]
            go = (top > -np.inf) & ((top >= kth) | (top >= limit[who, best]))
            who, best = who[go], best[go]
            if not len(who):
                break
            looked[who, best] = True
            around = graph[best]
            row = np.repeat(who, graph.shape[1])[around.ravel() >= 0]
            met = around.ravel()[around.ravel() >= 0]
            new = score[row, met] == -np.inf
            row, met = row[new], met[new]
            score[row, met] = np.einsum("ij,ij->i", unit[q[row]], unit[met])
        row, x = np.nonzero(score >= limit)
        keep = q[row] != x
        pairs_q.append(np.minimum(q[row], x)[keep])
        pairs_x.append(np.maximum(q[row], x)[keep])
    code = np.unique(np.concatenate(pairs_q) * n + np.concatenate(pairs_x))
    return code // n, code % n


def _grown(classes: DataFrame, near: float, shard_rows: int, branch: int, sample: int, dense: int):
    """Shards ``(grp, node, rep, ball, vector)``, home rows of balls ``(rep, ball)`` and copies near a ball ``(rep, ball)``.

    Every level samples all open nodes, takes balls out of them and cuts those that are still too large.
    """
    everything = classes.select("grp", F.lit("").alias("node"), "rep", F.lit(True).alias("home"), F.lit(False).alias("ball"), "vector")
    open_rows, shards, inside = everything, [], []

    def learn(group: pa.Table) -> pa.Table:
        unit = _unit(_matrix(group.column("vector")))
        size = group.column("size")[0].as_py()
        # A pivot that is one already has gathered its members.
        fresh = ~group.column("ball").to_numpy(zero_copy_only=False)
        pivots = np.flatnonzero(fresh)[pivots_of(unit[fresh], near, dense)] if fresh.any() else np.zeros(0, np.int64)
        others = np.ones(len(unit), bool)
        if len(pivots):
            others &= (unit @ unit[pivots].T < near).all(axis=1)
        # Every row goes to two of the new nodes, and these are not all equally large.
        count = min(branch, -(-5 * size // (2 * shard_rows))) if size > shard_rows else 0
        centres = centres_of(unit[others], count) if count and others.any() else np.zeros((0, unit.shape[1]))
        reps = group.column("rep").to_numpy()[pivots]
        return pa.table({
            "grp": group.column("grp").slice(0, 1), "node": group.column("node").slice(0, 1), "width": [unit.shape[1]],
            "pivots": pa.array([reps.tolist()], pa.list_(pa.int64())), "at": [unit[pivots].tobytes()], "centres": [centres.tobytes()],
        })

    def deal(rows: pa.Table, plan: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"node": [], "rep": [], "home": [], "ball": [], "of": [], "last": [], "vector": [], "grp": []}, schema)
        unit = _unit(_matrix(rows.column("vector")))
        width = plan.column("width")[0].as_py()
        pivots = np.array(plan.column("pivots")[0].as_py(), np.int64)
        at, centres = [np.frombuffer(plan.column(c)[0].as_py(), np.float64).reshape(-1, width) for c in ("at", "centres")]
        n = rows.num_rows
        rep, home, ball = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "home", "ball"))
        of = np.full(n, -1, np.int64)
        if len(pivots):
            score = unit @ at.T
            best = score.argmax(axis=1)
            took = (score[np.arange(n), best] >= near) & ~ball
            of[took] = pivots[best[took]]
        node = rows.column("node")[0].as_py()
        # Members end here, but a pivot goes on for its ball; so does every other row.
        on = np.flatnonzero((of < 0) | (of == rep))
        goes_ball = ball[on] | (of[on] == rep[on])
        if len(centres) > 1:
            order = np.argsort(-(unit[on] @ centres.T), axis=1, kind="stable")[:, :2]
            second = np.flatnonzero(home[on])
            index = np.concatenate([on, on[second]])
            to = np.concatenate([order[:, 0], order[second, 1]])
            homes = np.concatenate([home[on], np.zeros(len(second), bool)])
            balls = np.concatenate([goes_ball, goes_ball[second]])
            nodes, last = [f"{node}/{t}" for t in to.tolist()], np.zeros(len(index), bool)
        else:
            index, homes, balls = on, home[on], goes_ball
            nodes, last = [node] * len(on), np.ones(len(on), bool)
        members = np.flatnonzero(of >= 0)
        both = np.concatenate([index, members])
        return pa.table({
            "node": pa.array(nodes + [None] * len(members), pa.string()), "rep": rep[both],
            "home": np.concatenate([homes, home[members]]), "ball": np.concatenate([balls, np.zeros(len(members), bool)]),
            "of": pa.array(np.concatenate([np.zeros(len(index), np.int64), of[members]]), mask=np.arange(len(both)) < len(index)),
            "last": np.concatenate([last, np.ones(len(members), bool)]),
            "vector": pa.array([v for v in rows.column("vector").take(pa.array(index)).to_pylist()] + [None] * len(members), pa.binary()),
            "grp": pa.array([rows.column("grp")[0].as_py()] * len(both)),
        }, schema)

    names = {"node": pa.string(), "rep": pa.int64(), "home": pa.bool_(), "ball": pa.bool_(), "of": pa.int64(), "last": pa.bool_(), "vector": pa.binary(), "grp": pa.string()}
    schema = pa.schema(list(names.items()))
    while True:
        sizes = open_rows.groupBy("grp", "node").agg(F.count("*").alias("size"))
        sizes = materialize(sizes.withColumn("salts", F.ceil(F.col("size") / (4 * sample)).cast("int")), "nodes")
        # A sample of about `sample` rows of every node, by a hash of the ids.
        drawn = open_rows.join(sizes, ["grp", "node"]).where(F.pmod(F.xxhash64("rep", "node"), "size") < sample)
        plans = drawn.groupBy("grp", "node").applyInArrow(learn, "grp string, node string, width long, pivots array<long>, at binary, centres binary")
        plans = materialize(plans, "plans")
        every = sizes.select("grp", "node", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        plans = plans.join(every, ["grp", "node"])
        salted = open_rows.join(sizes.select("grp", "node", "salts"), ["grp", "node"]).withColumn("salt", F.pmod(F.xxhash64("rep"), "salts").cast("int"))
        keys = ["grp", "node", "salt"]
        dealt = salted.groupBy(*keys).cogroup(plans.groupBy(*keys)).applyInArrow(
            deal, "node string, rep long, home boolean, ball boolean, of long, last boolean, vector binary, grp string"
        )
        dealt = materialize(dealt, "dealt")
        inside.append(dealt.where("of is not null").select("grp", "rep", "of", "home"))
        shards.append(dealt.where("of is null and last").select("grp", "node", "rep", "ball", "vector"))
        open_rows = dealt.where("not last").select("grp", "node", "rep", "home", "ball", "vector")
        if open_rows.isEmpty():
            return _union(shards), _union(inside)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def _graph(shards: DataFrame) -> DataFrame:
    """``(rep, around)``: the united lists of neighbours of every row."""

    def build(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        lists = both_ways(robust_pruned(_unit(_matrix(group.column("vector")))), DEGREE)
        return pa.table({"rep": rep, "around": pa.array([rep[row[row >= 0]] for row in lists], pa.list_(pa.int64()))})

    lists = shards.groupBy("grp", "node").applyInArrow(build, "rep long, around array<long>")
    # A row is in as many shards as the tree has levels, and one more, at most.
    return lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("around"))).alias("around"))


def _found(shards: DataFrame, graph: DataFrame, cosine_least: float, beam: int) -> DataFrame:
    """``(grp, a, b, cosine)``: pairs of single vectors and balls in range of each other."""
    angle = math.acos(cosine_least)

    def search(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        rep, ball = group.column("rep").to_numpy(), group.column("ball").to_numpy(zero_copy_only=False)
        unit = _unit(_matrix(group.column("vector")))
        lists = group.column("around").to_pylist()
        lengths = [len(x) for x in lists]
        graph = np.full((len(rep), max(lengths)), -1, np.int64)
        graph[np.repeat(np.arange(len(rep)), lengths), np.concatenate([np.arange(x) for x in lengths])] = np.concatenate(lists).astype(np.int64)
        at = np.minimum(np.searchsorted(rep, graph), len(rep) - 1)
        graph = np.where((rep[at] == graph) & (graph >= 0), at, -1)  # neighbours outside of the shard are met in theirs
        reach = np.cos(angle + 2 * angle * ball)  # wide enough for two balls
        a, b = range_search(unit, graph, reach, beam)
        cosine = np.einsum("ij,ij->i", unit[a], unit[b])
        good = cosine >= np.cos(angle * (1.0 + ball[a] + ball[b]))
        good |= cosine >= cosine_least
        a, b, cosine = a[good], b[good], cosine[good]
        grp = pa.array([group.column("grp")[0].as_py()] * len(a), pa.string())
        return pa.table({"grp": grp, "a": rep[a], "b": rep[b], "cosine": cosine})

    joined = shards.join(graph, "rep")
    pairs = joined.groupBy("grp", "node").applyInArrow(search, "grp string, a long, b long, cosine double")
    return pairs.groupBy("grp", "a", "b").agg(F.max("cosine").alias("cosine"))


def _verified(pairs: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """``(rep, other, links)``: for members of pairs ``(a, b)`` of units, or of one unit, how many rows of the other they link with.

    ``other`` is one of those. ``members`` has ``(unit, block, rep, rows, vector)``; blocks meet, in one task each, and give counts.
    """
    blocks = members.groupBy("unit").agg((F.max("block") + 1).alias("blocks"))
    for side in "ab":
        pairs = pairs.join(blocks.select(F.col("unit").alias(side), F.col("blocks").alias(f"n{side}")), side)
        pairs = pairs.withColumn(f"b{side}", F.explode(F.sequence(F.lit(0), F.col(f"n{side}") - 1)))
    pairs = materialize(pairs.where("a <> b or ba <= bb").select("a", "b", "ba", "bb"), "meetings")
    keys = ["a", "b", "ba", "bb"]

    def side(name: str) -> DataFrame:
        own = members.select(*[F.col(old).alias(new) for old, new in (("unit", name), ("block", f"b{name}"), ("rep", "rep"), ("rows", "rows"), ("vector", "vector"))])
        return own.join(pairs.select(*[F.col(k).alias(k) for k in keys]), [name, f"b{name}"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        x, y = _unit(_matrix(left.column("vector"))), _unit(_matrix(right.column("vector")))
        linked = x @ y.T >= cosine
        linked &= left.column("rep").to_numpy()[:, None] != right.column("rep").to_numpy()
        out, within = [], all(left.column(n)[0].as_py() == left.column(m)[0].as_py() for n, m in (("a", "b"), ("ba", "bb")))
        for rows, other, how in ((left, right, linked), (right, left, linked.T))[: 1 if within else 2]:
            some = np.flatnonzero(how.any(axis=1))
            first = other.column("rep").to_numpy()[how[some].argmax(axis=1)]
            out.append((rows.column("rep").to_numpy()[some], first, how[some].astype(np.int64) @ other.column("rows").to_numpy()))
        return pa.table({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("rep", "other", "links"))})

    return side("a").groupBy(*keys).cogroup(side("b").groupBy(*keys)).applyInArrow(meet, "rep long, other long, links long")


def _audited(classes: DataFrame, counts: DataFrame, cosine: float, audit_rows: int) -> float:
    """The share of the links of some vectors, found by brute force over all rows, that the graph has found."""
    asked = classes.orderBy(F.xxhash64("rep"), "rep").limit(audit_rows).select("grp", "rep", "vector").toArrow()
    queries: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for grp in set(asked.column("grp").to_pylist()):
        own = asked.filter(pa.compute.equal(asked.column("grp"), grp))
        queries[grp] = (own.column("rep").to_numpy(), _unit(_matrix(own.column("vector"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: dict[int, int] = {}
        for batch in batches:
            groups = np.array(batch.column("grp").to_pylist(), object)
            for grp in set(groups.tolist()) & queries.keys():
                rows = batch.take(pa.array(np.flatnonzero(groups == grp)))
                reps, unit = queries[grp]
                near = unit @ _unit(_matrix(rows.column("vector"))).T >= cosine
                near &= reps[:, None] != rows.column("rep").to_numpy()
                for rep, n in zip(reps.tolist(), (near @ rows.column("rows").to_numpy()).tolist()):
                    links[rep] = links.get(rep, 0) + n
        yield pa.RecordBatch.from_pydict({"rep": pa.array(links.keys(), pa.int64()), "links": pa.array(links.values(), pa.int64())})

    truth = classes.mapInArrow(run, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("wanted"))
    both = truth.join(counts, "rep", "left").agg(F.sum("wanted"), F.sum(F.coalesce("links", F.lit(0)))).first()
    return (both[1] or 0) / both[0] if both[0] else 1.0


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS, branch: int = BRANCH, sample: int = SAMPLE,
                    dense: int = DENSE, beam: int = BEAM, recall: float = RECALL, audit_rows: int = AUDIT,
                    key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row; ``kept`` tells the one with the smallest id of its component."""
    rows = narrow(vectors, vec_id=key, vector=vector, label=label)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "vector")
    good = materialize(usable(rows), "usable")
    classes = good.groupBy("grp", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("rows"))
    classes = materialize(classes, "classes")
    if classes.isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    shards, inside = _grown(classes, cosine, shard_rows, branch, sample, dense)
    shards, inside = materialize(shards.distinct(), "shards"), materialize(inside.distinct(), "inside")
    graph = materialize(_graph(shards), "graph")
    # A row's unit: the ball that took its home row, or itself.
    home = inside.where("home").select("rep", F.col("of").alias("unit"))
    units = classes.select("grp", "rep", "rows", "vector").join(home, "rep", "left").withColumn("unit", F.coalesce("unit", "rep"))
    units = materialize(units, "units")
    weight = materialize(units.groupBy("unit").agg(F.sum("rows").alias("rows"), F.count("*").alias("members")), "weights")
    copies = inside.where("not home").select("grp", F.col("rep").alias("a"), F.col("of").alias("b"))

    for attempt in range(ATTEMPTS):
        found = _found(shards, graph, cosine, beam << attempt)
        links, edges = _links(found, copies, units, weight, cosine)
        links = materialize(links, "links")
        if _audited(classes, links, cosine, audit_rows) >= recall:
            break

    reached = components(edges)
    placed = classes.select("grp", "vector", "rep", "rows").join(links, "rep", "left")
    placed = placed.join(reached.select(F.col("id").alias("rep"), "component"), "rep", "left")
    # The copies of a vector are rows with ids of their own.
    own = good.join(placed, ["grp", "vector"]).select(
        F.col("vec_id").alias("id"), (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    own = own.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    joined = rows.select("vec_id").join(own, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _links(found: DataFrame, copies: DataFrame, units: DataFrame, weight: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """``(rep, links)``, rows linked with each class but its own, and edges ``(a, b)`` that connect the same classes."""
    unit = units.select("rep", "unit")
    # Pairs of a copy that a ball took in another node have no cosine yet.
    pairs = found.select("a", "b", "cosine").union(copies.select("a", "b", F.lit(None).cast("double")))
    for side in "ab":
        pairs = pairs.join(unit.select(F.col("rep").alias(side), F.col("unit").alias(f"u{side}")), side)
    # A cosine is that of units only if neither end was taken by a ball.
    pairs = pairs.withColumn("cosine", F.when((F.col("a") == F.col("ua")) & (F.col("b") == F.col("ub")), F.col("cosine"))).where("ua <> ub")
    pairs = pairs.groupBy(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).agg(F.max("cosine").alias("cosine"))
    for side in "ab":
        pairs = pairs.join(weight.select(F.col("unit").alias(side), F.col("rows").alias(f"r{side}"), F.col("members").alias(f"m{side}")), side)
    pairs = materialize(pairs.withColumn("single", F.expr("ma = 1 and mb = 1 and cosine is not null")), "pairs")

    certain = pairs.where(F.col("single") & (F.col("cosine") >= cosine))
    certain = certain.select(F.col("a").alias("rep"), F.col("b").alias("other"), F.col("rb").alias("links")).union(certain.select("b", "a", "ra"))
    met = pairs.where("not single").select("a", "b").union(weight.where("members > 1").select("unit", "unit"))
    touched = met.select(F.col("a").alias("unit")).union(met.select("b")).distinct()
    members = units.join(touched, "unit", "left_semi").join(weight.select("unit", "members"), "unit")
    parts = F.ceil(F.col("members") / BLOCK)
    members = materialize(members.select("unit", F.pmod(F.xxhash64("rep"), parts).cast("int").alias("block"), "rep", "rows", "vector"), "members")
    linked = materialize(certain.union(_verified(met, members, cosine)), "linked")

    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    # Members of a ball are linked with its pivot.
    edges = linked.select(F.col("rep").alias("a"), F.col("other").alias("b")).union(units.where("rep <> unit").select("rep", "unit"))
    return links, edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
