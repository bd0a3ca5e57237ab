"""Near-duplicates by one-permutation MinHash with optimal densification.

1. One hash of each shingle gives its bin (the high part) and its rank; a bin keeps its least
   hash. An empty bin borrows from the first non-empty one in a random sequence of bins of its
   own, the same for all documents. Bands of bins are hashed into bucket keys.
2. Documents with equal sets are one class, represented by its smallest id.
3. Every bucket gives star-shaped candidates: one member against each other member, as many pairs as members. First
   each member is confirmed, on the full sets, against the one centre that is least by the hash of its id among those of its
   buckets, which is the same in all buckets of a family; links make components. Then every bucket gets a
   centre of its own, and those pairs are confirmed whose ends are in different components by then. Pairs whose sizes rule
   out the threshold go. Later links connect components, not documents.
4. Stars can miss a link between two members that are both unlike the centres. So all members of
   buckets that still hold several components are compared exactly, by the rarest shingles: of
   two linked sets, each has one of the other's among its own ``n - ceil(0.8 n) + 1`` rarest, in
   any order that is the same for all. Members that share such a shingle and are in different
   components are confirmed on the full sets. A family of near copies, each with changes of its own, meets
   in every bucket, but its members' rarest shingles are those changes, so they give no pairs.

With 42 bands of 6 bins two documents at similarity 0.8 share no bucket once in 350,000 pairs, and
at 0.9 never in practice. Candidates are not limited in number, and links are exact.

Defined cases: A-Z are lower-cased and words are cut at ``[\\x20\\x09-\\x0D]``. A text with fewer
words than a shingle has its whole sequence as its one shingle; a null, empty or blank text has
none and is linked with nothing. Ids are taken to be unique: repeated rows of a document
all get its result. Rows with a null id are linked with nothing and keep a null component. Other columns
are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import column_bytes, map_batches, mix, narrow, parts, signed
from docloom.llm.components import components
from docloom.session import materialize

BANDS = 42
ROWS = 6

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, in order."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    rows = len(words) - width + 1
    with np.errstate(over="ignore"):
        # A text shorter than a shingle is like no shingle of that size.
        made = np.full(rows, _SHORT * np.uint64(len(words)) if len(words) < size else 0, np.uint64)
        for i in range(width):
            made = (made ^ (made >> np.uint64(31))) * _MULTIPLIER + hashed[i : rows + i]
    return np.unique(mix(made))


class Sketcher:
    """Bucket keys of sets of hashes."""

    def __init__(self, bands: int, rows: int):
        self._bands, self._rows, self._bins = bands, rows, bands * rows
        self._tries = np.zeros((0, self._bins), np.int64)

    def _donors(self, tries: int) -> np.ndarray:
        """The bins that each bin asks in turn."""
        if len(self._tries) < tries:
            seeds = np.arange(tries * self._bins, dtype=np.uint64) + np.uint64(1)
            self._tries = (mix(seeds) % np.uint64(self._bins)).astype(np.int64).reshape(tries, self._bins)
        return self._tries

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """A key for each band; ``hashes`` are distinct, in order and not none."""
        with np.errstate(over="ignore"):
            bins = ((hashes >> np.uint64(32)) * np.uint64(self._bins) >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.diff(bins, prepend=-1))
            values = np.zeros(self._bins, np.uint64)
            filled = np.zeros(self._bins, bool)
            values[bins[first]], filled[bins[first]] = hashes[first], True
            empty, tried = np.flatnonzero(~filled), 0
            while len(empty):
                step = 32 if not tried else tried
                donors = self._donors(tried + step)[tried : tried + step, empty]
                given = filled[donors]
                turn = given.argmax(axis=0)
                found = given.any(axis=0)
                chosen = donors[turn, np.arange(len(empty))]
                values[empty[found]] = values[chosen[found]]
                empty, tried = empty[~found], tried + step
            keys = np.arange(self._bands, dtype=np.uint64) * _SHORT
            for row in values.reshape(self._bands, self._rows).T:
                keys = mix(keys * _MULTIPLIER + row)
        return keys


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, hashes binary)``: the shingles of every row with an id, eight bytes each."""

    def run(batch: pa.RecordBatch) -> dict:
        made = [signed(shingles(t, size)).tobytes() for t in column_bytes(batch, "text")]
        return {"doc_id": batch.column("doc_id"), "hashes": pa.array(made, pa.binary())}

    return map_batches(docs, run, "doc_id long, hashes binary")


def _sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, n, digest, keys)`` of every row; no digest and keys without shingles."""
    sketcher = Sketcher(bands, rows)

    def run(batch: pa.RecordBatch) -> dict:
        n, digests, keys = [], [], []
        for text in column_bytes(batch, "text"):
            hashes = shingles(text, size)
            n.append(len(hashes))
            digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
            keys.append(signed(sketcher.keys(hashes)) if len(hashes) else None)
        return {
            "doc_id": batch.column("doc_id"),
            "n": pa.array(n, pa.int64()),
            "digest": pa.array(digests, pa.binary()),
            "keys": pa.array(keys, pa.list_(pa.int64())),
        }

    return map_batches(docs, run, "doc_id long, n long, digest binary, keys array<long>")


def _could_link(n: str, m: str, percent: int):
    """Two sets of these sizes can reach the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                # Both are in order and without repeats; a binary search of the shorter in the longer.
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a")
    joined = joined.join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sharing_rare(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of members ``(rep, n, c)`` of different ``c`` that can be linked, by their rarest shingles."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = [np.frombuffer(h, np.int64) for h in batch.column("hashes").to_pylist()]
            rep = np.repeat(batch.column("doc_id").to_numpy(), [len(f) for f in found])
            tokens = np.concatenate(found)
            for begin in range(0, len(rep), 100_000):
                made = [pa.array(rep[begin : begin + 100_000]), pa.array(tokens[begin : begin + 100_000])]
                yield pa.RecordBatch.from_arrays(made, ["rep", "token"])

    own = sets.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    tokens = own.mapInArrow(explode, "rep long, token long").distinct()
    # A shingle of one member only has no partner, but it does count among the rarest.
    often = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    shared = tokens.join(often, "token").join(members, "rep")
    whole = Window.partitionBy("rep")
    rank = F.row_number().over(whole.orderBy("f", "token"))
    least = F.ceil(F.col("n") * percent / 100)
    rare = shared.withColumn("rank", rank).withColumn("held", F.count("*").over(whole)).where(F.col("rank") <= F.col("held") - least + 1)
    # The place among all shingles of the member, those without a partner first.
    rare = materialize(rare.select("token", "rep", "n", "c", (F.col("n") - F.col("held") + F.col("rank")).alias("i")), "rare")

    # In each shingle only members outside its largest component are compared with the others.
    held = rare.groupBy("token", "c").agg(F.count("*").alias("held"))
    largest = held.groupBy("token").agg(F.max_by("c", F.struct("held", "c")).alias("main"), F.count("*").alias("parts"))
    mixed = rare.join(largest.where("parts > 1").select("token", "main"), "token")
    outside = mixed.where("c <> main").select("token", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"), F.col("i").alias("ia"))
    others = mixed.select("token", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), F.col("i").alias("ib"), "main")
    # Two members outside the largest component meet once, by the order of their ids. Where the first
    # shingle they share is at these places, they share no more than it and what follows in either.
    enough = (1 + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    meet = outside.join(others, "token").where("ca <> cb and (cb = main or a < b)").where(_could_link("na", "nb", percent) & enough)
    return meet.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document.

    Documents are linked when 100 times the size of the intersection of their sets of ``size``-word
    shingles is at least ``percent`` times that of the union. ``component_id`` is the smallest id that can be
    reached over links, ``kept`` tells the document that has it.
    """
    narrowed = narrow(docs, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    sketches = materialize(_sketches(narrowed, size, bands, rows), "sketches")

    # Classes of equal sets.
    known = sketches.where("doc_id is not null and digest is not null")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    classes = materialize(classes, "classes")
    buckets = classes.select("rep", "n", F.explode("keys").alias("bucket"))

    # Members of buckets with several classes.
    chosen, same = F.xxhash64("bucket", "rep"), F.xxhash64("rep")
    several = buckets.groupBy("bucket").agg(
        F.min_by("rep", chosen).alias("centre"), F.min_by("n", chosen).alias("centre_n"),
        F.min_by("rep", same).alias("lead"), F.min_by("n", same).alias("lead_n"),
        F.min("rep").alias("first"), F.max("rep").alias("last"),
    )
    members = buckets.join(several.where("first <> last").drop("first", "last"), "bucket")
    members = materialize(members, "members")

    # Full sets of those members only.
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = materialize(_sets(narrowed.join(wanted, "doc_id", "left_semi"), size), "sets")

    # One pair for each member.
    leads = members.where("rep <> lead").where(_could_link("n", "lead_n", percent))
    leads = leads.groupBy("rep").agg(F.min_by("lead", F.xxhash64("lead")).alias("lead"))
    leads = leads.select(F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b")).distinct()
    leads = materialize(leads, "leads")
    found = components(_confirmed(leads, sets, percent))

    # Pairs with the buckets' own centres that would connect components.
    stars = members.where("rep <> centre").where(_could_link("n", "centre_n", percent))
    stars = stars.select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")).distinct()
    for side in "ab":
        stars = stars.join(found.select(F.col("id").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    stars = stars.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(leads, ["a", "b"], "left_anti")
    stars = materialize(stars, "stars")
    links = materialize(_confirmed(stars, sets, percent), "links")
    found = found if links.isEmpty() else _contracted(found, links)

    # What stars leave open: members of one bucket in different components.
    placed = members.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
    placed = placed.select("bucket", "rep", "n", F.coalesce("component", "rep").alias("c"))
    parts = placed.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    mixed = materialize(placed.join(parts, "bucket", "left_semi").select("rep", "n", "c").distinct(), "mixed")
    left = _sharing_rare(mixed, sets, percent).join(leads.union(stars), ["a", "b"], "left_anti")
    more = materialize(_confirmed(left, sets, percent), "links")

    reached = found if more.isEmpty() else _contracted(found, more)
    reps = classes.select(F.col("digest").alias("_digest"), "rep")
    reps = reps.join(reached.select(F.col("id").alias("rep"), "component"), "rep", "left")
    reps = reps.select("_digest", F.coalesce("component", "rep").alias("component"))
    placed = sketches.select("doc_id", "n", "digest").join(reps, F.col("digest") == F.col("_digest"), "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), "doc_id")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _contracted(found: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, component)`` after more links ``(a, b)``, worked out over the components found so far."""
    named = links
    for side in "ab":
        named = named.join(found.select(F.col("id").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    over = components(named.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct())
    after = over.select(F.col("id").alias("component"), F.col("component").alias("to"))
    moved = found.join(after, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    fresh = over.join(found.select("id"), "id", "left_anti").select("id", "component")
    return materialize(moved.union(fresh), "components")


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is the one kept of its component."""
    gone = near_duplicates(docs, key=key, **options).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
