"""A Merkle manifest of a dataset: ternary hash trees kept as postorder logs.

Every source is a tree over its rows in the order of their ids; the trees' roots, in the order of the sources, are
the leaves of one more tree. Three consecutive nodes become their hash, and so does a last run of fewer.

Builders work on aligned blocks of ``3 ** LEVELS`` nodes. A builder appends a node's digest to its log as soon as the
node is complete: a leaf when it comes, its parent right after the last child. So a log is in postorder, and
the place of any node follows from the sizes of the subtrees before it (``place``); nothing needs an index. The
roots of a block are the nodes of the next tier, which is built in the same way, until one node is left. For a proof
the places of the siblings are worked out and read from the block's log; what lies above the block is the
same for all its rows and is read once from the next tier.

A tree's rows are numbered by sorting ranges of ids, so a source that holds most of all rows is
sorted, built and read by many tasks; no task holds more than a range or a block. Tiers are written tables. Only the
one root hash comes to the driver.

Defined cases: a null field hashes as ``-``, any other as its byte count, ``:`` and value. A null source is a source of its own
and comes first; a null id comes before all others and is never tampered with. Repeated ids are in the order of their
leaf hashes, so equal rows may change places without a change to any digest. Texts are hashed whole. Only
the named columns are read, so others may have any name. An empty table has no root and gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import narrow
from docloom.session import materialize

ARITY = 3
LEVELS = 6
SIZE = 32

_KEY = "tree string, block long"


def join_hash(digests: bytes) -> bytes:
    """The hash of a run of nodes: of their digests as lowercase hex, one after the other."""
    return sha256(digests.hex().encode()).digest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def place(level: int, index: int, n: int, top: int) -> int:
    """Where node ``index`` of ``level`` stands in the log of a tree of ``n`` leaves and ``top`` levels above them.

    The node is complete with leaf number ``end``. Until then each level up to its own has as many nodes as
    the leaves up to ``end`` fill or begin, each higher one as many as the leaves before ``end`` fill.
    """
    end = min((index + 1) * ARITY**level, n)
    own = sum(-(-end // ARITY**q) for q in range(level + 1))
    return own + sum((end - 1) // ARITY**q for q in range(level + 1, top + 1)) - 1


def append_log(digests: list[bytes], top: int) -> bytes:
    """The log of a block: digests of its nodes in the order in which they are complete."""
    log, open_runs = [], [[] for _ in range(top + 1)]

    def append(level: int, digest: bytes) -> None:
        log.append(digest)
        run = open_runs[level]
        run.append(digest)
        if level < top and len(run) == ARITY:
            open_runs[level] = []
            append(level + 1, join_hash(b"".join(run)))

    for digest in digests:
        append(0, digest)
    for level in range(top):
        if run := open_runs[level]:
            open_runs[level] = []
            append(level + 1, join_hash(b"".join(run)))
    return b"".join(log)


def siblings(log: bytes, index: int, n: int, top: int) -> bytes:
    """A leaf's proof within a block: for each level its place in the run, the run's length, and the others' digests."""
    out = []
    for level in range(top):
        first = index - index % ARITY
        count = min(ARITY, -(-n // ARITY**level) - first)
        out.append(bytes((index - first, count)))
        for other in range(first, first + count):
            if other != index:
                at = SIZE * place(level, other, n, top)
                out.append(log[at : at + SIZE])
        index //= ARITY
    return b"".join(out)


def proof_digests(path: bytes) -> bytes:
    """The siblings' digests of a proof, one after the other."""
    out, at = [], 0
    while at < len(path):
        size = SIZE * (path[at + 1] - 1)
        out.append(path[at + 2 : at + 2 + size])
        at += 2 + size
    return b"".join(out)


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    at = 0
    while at < len(path):
        own, size = path[at], SIZE * (path[at + 1] - 1)
        others = path[at + 2 : at + 2 + size]
        digest = join_hash(others[: SIZE * own] + digest + others[SIZE * own :])
        at += 2 + size
    return digest


def leaf_hash(*fields: Column) -> Column:
    """The hash of a row, 32 bytes."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``pos``, their number within ``tree`` in the given order, and ``n``, the tree's size."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()).withColumn("at", number), "ranges")
    held = ranged.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    tree = Window.partitionBy("tree")
    before = F.sum("held").over(tree.orderBy("range")) - F.col("held") - F.col("first")
    held = materialize(held.select("tree", "range", before.alias("before"), F.sum("held").over(tree).alias("n")), "sizes")
    joined = ranged.join(held, ["tree", "range"])
    return joined.select(*rows.columns, (F.col("before") + F.col("at")).alias("pos"), "n")


@dataclass(frozen=True)
class Forest:
    """Trees over numbered nodes. ``tiers`` has, from the leaves up, nodes ``(tree, block, i, n, digest)`` and the blocks'
    logs ``(tree, block, n, log)``, where ``n`` is the number of nodes of the tree in this tier."""

    tiers: list[tuple[DataFrame, DataFrame]]
    levels: int

    @property
    def block(self) -> int:
        return ARITY**self.levels

    @staticmethod
    def build(nodes: DataFrame, levels: int = LEVELS) -> Forest:
        """``nodes``: ``(tree, pos, n, digest)``."""
        width, tiers = ARITY**levels, []

        def log(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("i")
            n, block = rows.column("n")[0].as_py(), rows.column("block")[0].as_py()
            made = append_log(rows.column("digest").to_pylist(), min(levels, height(n)))
            return pa.table({"tree": rows.column("tree").slice(0, 1), "block": [block], "n": [n], "log": [made]})

        while True:
            cut = nodes.select("tree", F.expr(f"pos div {width}").alias("block"), (F.col("pos") % width).cast("int").alias("i"), "n", "digest")
            logs = cut.groupBy("tree", "block").applyInArrow(log, f"{_KEY}, n long, log binary")
            logs = materialize(logs, "logs")
            tiers.append((cut, logs))
            higher = logs.where(f"n > {width}")
            if higher.isEmpty():
                return Forest(tiers, levels)
            nodes = higher.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), _last("log"))

    def roots(self) -> DataFrame:
        """``(tree, digest)``."""
        tops = [logs.where(f"n <= {self.block}").select("tree", _last("log")) for _, logs in self.tiers]
        return _union(tops)

    def paths(self, leaves: DataFrame | None, finish: Callable[[dict, list[bytes]], dict], schema: str, above: DataFrame) -> DataFrame:
        """``finish`` applied to blocks of ``leaves`` and the proofs of their rows, up to and with ``above`` ``(tree, path)``.

        ``leaves`` has ``(tree, block, i)`` and what ``finish`` needs; without it the forest's own nodes are taken.
        """

        width = self.block

        def of_nodes(rows: dict, found: list[bytes]) -> dict:
            return {"tree": rows["tree"], "pos": [width * b + i for b, i in zip(rows["block"], rows["i"])], "path": found}

        higher = None
        for tier in range(len(self.tiers) - 1, -1, -1):
            nodes, logs = self.tiers[tier]
            topped = logs.where(f"n <= {self.block}").join(above, "tree").select(*logs.columns, "path")
            if higher is not None:
                inner = logs.where(f"n > {self.block}").join(higher.withColumnRenamed("pos", "block"), ["tree", "block"])
                topped = topped.union(inner.select(*logs.columns, "path"))
            if tier:
                higher = materialize(self._read(nodes, topped, of_nodes, "tree string, pos long, path binary"), "paths")
            else:
                return self._read(nodes if leaves is None else leaves, topped, finish, schema)
        raise AssertionError("a forest has a tier at least")

    def _read(self, nodes: DataFrame, logs: DataFrame, finish, schema: str) -> DataFrame:
        width, levels = self.block, self.levels

        def read(rows: pa.Table, logs: pa.Table) -> pa.Table:
            block, n, log, path = (logs.column(c)[0].as_py() for c in ("block", "n", "log", "path"))
            held, top = min(width, n - block * width), min(levels, height(n))
            rows = rows.to_pydict()
            return pa.Table.from_pydict(finish(rows, [siblings(log, i, held, top) + path for i in rows["i"]]))

        return nodes.groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(read, schema)

    def log(self) -> DataFrame:
        """``(tree, position, digest)``: one log for each whole tree, its nodes placed by ``place``."""
        width, levels = self.block, self.levels

        def spread(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    tier, n, whole = row["tier"], row["n"], row["whole"]
                    held, top = min(width, n - row["block"] * width), min(levels, height(n))
                    places, digests = [], []
                    for level in range(1 if tier else 0, top + 1):
                        first = row["block"] * ARITY ** (levels - level)
                        for i in range(-(-held // ARITY**level)):
                            at = SIZE * place(level, i, held, top)
                            digests.append(row["log"][at : at + SIZE])
                            places.append(place(levels * tier + level, first + i, whole, height(whole)))
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([row["tree"]] * len(places), pa.string()), "position": places, "digest": digests})

        whole = self.tiers[0][1].select("tree", F.col("n").alias("whole")).distinct()
        parts = [logs.withColumn("tier", F.lit(t)).join(whole, "tree") for t, (_, logs) in enumerate(self.tiers)]
        return _union(parts).mapInArrow(spread, "tree string, position long, digest binary")


def _last(log: str) -> Column:
    """A block's own root: the last digest of its log."""
    return F.substring(log, F.length(log) - SIZE + 1, F.lit(SIZE)).alias("digest")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@dataclass(frozen=True)
class Manifest:
    """The forest of the sources, the tree over their roots, and the rows of the dataset.

    ``leaves``: ``(tree, block, i, source, doc_id, leaf, altered)``; ``altered`` is null where a row was not tampered with.
    """

    leaves: DataFrame
    sources: Forest
    top: Forest
    subroots: DataFrame
    root: bytes

    @staticmethod
    def build(docs: DataFrame, altered: Column | None = None, when: Column | None = None, levels: int = LEVELS, key: str = "doc_id",
              source: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text") -> Manifest | None:
        """The manifest of ``docs``; None if it is empty.

        ``altered``, over the columns ``id`` and ``f0``, ``f1``, ... for ``fields``, is what stands in place of ``text``
        in a copy of the dataset, in the rows for which ``when`` holds; their leaves are hashed from it as well.
        """
        rows = narrow(docs, id=key, source=source, **{f"f{i}": f for i, f in enumerate(fields)})
        values = [F.col(f"f{i}") for i in range(len(fields))]
        leaf, other = leaf_hash(*values), F.lit(None).cast("binary")
        if altered is not None:
            other = F.when(when, leaf_hash(*[altered if f == text else v for f, v in zip(fields, values)]))
        tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # in the order of the sources, null first
        hashed = materialize(rows.select(tree.alias("tree"), F.col("id").alias("doc_id"), leaf.alias("leaf"), other.alias("altered")), "leaves")
        if hashed.isEmpty():
            return None
        leaves = materialize(numbered(hashed, "doc_id", "leaf"), "numbered")
        width = ARITY**levels
        sources = Forest.build(leaves.select("tree", "pos", "n", F.col("leaf").alias("digest")), levels)
        subroots = materialize(sources.roots().select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), "subroots")
        subroots = materialize(numbered(subroots, "own"), "subroots")
        top = Forest.build(subroots.select("tree", "pos", "n", "digest"), levels)
        # One row.
        root = bytes(top.roots().first()["digest"])
        leaves = leaves.withColumn("block", F.expr(f"pos div {width}")).withColumn("i", (F.col("pos") % width).cast("int"))
        return Manifest(leaves.drop("pos", "n"), sources, top, subroots, root)

    def proofs(self) -> DataFrame:
        """``(doc_id, leaf, subroot, root, path, proof, folded_root)`` of every row, all binary but the id.

        ``path`` is the proof as ``fold`` takes it, ``proof`` the siblings' digests one after the other.
        """
        width = self.top.block
        own = self.subroots.select("tree", F.expr(f"pos div {width}").alias("block"), (F.col("pos") % width).cast("int").alias("i"), "own", F.col("digest").alias("subroot"))

        def of_source(rows: dict, found: list[bytes]) -> dict:
            return {"tree": rows["own"], "path": found}

        nothing = self.top.roots().select("tree", F.lit(b"").alias("path"))
        above = materialize(self.top.paths(own.select("tree", "block", "i", "own"), of_source, "tree string, path binary", nothing), "above")
        kind = dict(self.leaves.dtypes)["doc_id"]

        def of_row(rows: dict, found: list[bytes]) -> dict:
            folded = [fold(x if x is not None else leaf, path) for leaf, x, path in zip(rows["leaf"], rows["altered"], found)]
            return {
                "tree": rows["tree"], "doc_id": pa.array(rows["doc_id"], id_type), "leaf": rows["leaf"], "path": found,
                "proof": [proof_digests(p) for p in found], "folded_root": folded,
            }

        id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
        schema = f"tree string, doc_id {kind}, leaf binary, path binary, proof binary, folded_root binary"
        made = self.sources.paths(self.leaves, of_row, schema, above)
        subroots = self.subroots.select(F.col("own").alias("tree"), F.col("digest").alias("subroot"))
        return made.join(subroots, "tree").withColumn("root", F.lit(self.root)).drop("tree")


def audit(docs: DataFrame, altered: Column, when: Column, levels: int = LEVELS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``: which rows of an altered copy the manifest confirms."""
    manifest = Manifest.build(docs, altered, when, levels)
    if manifest is None:
        kind = dict(docs.dtypes)["doc_id"]
        names = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, {names}")
    text = {c: F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")}
    return manifest.proofs().select(
        "doc_id", text["leaf"], text["subroot"], text["root"],
        F.sha2(F.encode(F.lower(F.hex("proof")), "UTF-8"), 256).alias("proof_sha256"),
        text["folded_root"], (F.col("folded_root") == F.col("root")).alias("verified"),
    )
