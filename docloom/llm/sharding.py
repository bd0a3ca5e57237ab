"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``virtual`` nodes on a ring of 64-bit hashes, and a document belongs to the node
that follows the hash of its text. A shard takes no more than its bound: what its arcs hold beyond
that continues clockwise to the next shard with room. With loads counted in rows the bounds differ
by one at most and add up to the table, so counts are at most one apart; with loads in bytes a shard
closes with the document that crosses its bound. Equal texts are neighbours on the ring, so they
stay together unless a bound runs through them. Adding a shard moves what falls to its nodes and
what the changed bounds push on, not the rest.

The documents of one arc, however many, lie in several range partitions, ordered by hash and id.
Only sums by arc and partition, and then the parts into which bounds cut the arcs, reach the driver:
their number is that of arcs plus partitions, whatever the rows. Texts are hashed where they are
read and do not move.

Defined cases: a null text has no bytes, size 1 and checksum 0, and the place of the empty text.
Null ids come first among equal texts; repeated rows take a slot each. Only the two named columns
are read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import narrow
from docloom.session import materialize

SHARDS = 16
VIRTUAL = 64


def ring(shards: int, virtual: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all nodes, in order, and the shard of each arc.

    Arc i ends at node i. The arc from the last node to the first one goes over the end of the hashes;
    its first half is one arc more, of the same shard.
    """
    nodes = sorted((xxhash.xxh3_64_intdigest(f"{s}/{v}") - (1 << 63), s) for s in range(shards) for v in range(virtual))
    return np.array([p for p, _ in nodes], np.int64), np.array([s for _, s in [*nodes, nodes[0]]], np.int64)


def bounded(loads: np.ndarray, owners: np.ndarray, bounds: list[int]) -> list[tuple[int, int, int, int]]:
    """``(arc, from, to, shard)``: which part of the load of each arc goes to which shard.

    First every shard fills up with its own arcs in ring order, then the rest of each arc goes on
    clockwise.
    """
    room, parts, rest = list(bounds), [], []
    for arc, load in enumerate(loads.tolist()):
        own = min(load, room[owners[arc]])
        room[owners[arc]] -= own
        if own:
            parts.append((arc, 0, own, int(owners[arc])))
        if own < load:
            rest.append((arc, own, load))
    for arc, done, load in rest:
        step = arc
        while done < load:
            step = (step + 1) % len(owners)
            shard = int(owners[step])
            taken = min(load - done, room[shard])
            if taken:
                room[shard] -= taken
                parts.append((arc, done, done + taken, shard))
                done += taken
    return parts


def _on_ring(docs: DataFrame, places: np.ndarray, by_bytes: bool) -> DataFrame:
    """Rows in ring order with their arc, and the load and rows of the arc before them in their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, open_arc, load_before, rows_before = TaskContext.get().partitionId(), -1, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            arcs = np.searchsorted(places, batch.column("place").to_numpy(), side="left")
            loads = batch.column("size").to_numpy() if by_bytes else np.ones(n, np.int64)
            # Running sums that begin anew with each arc; the first arc may go on from the last batch.
            starts = np.flatnonzero(np.diff(arcs, prepend=-1))
            sums = np.concatenate([[0], np.cumsum(loads)])
            lengths = np.diff(np.append(starts, n))
            before = sums[:-1] - np.repeat(sums[starts], lengths)
            rank = np.arange(n) - np.repeat(starts, lengths)
            if arcs[0] == open_arc:
                before[: lengths[0]] += load_before
                rank[: lengths[0]] += rows_before
            open_arc, load_before, rows_before = arcs[-1], int(before[-1] + loads[-1]), int(rank[-1] + 1)
            kept = [batch.column(c) for c in ("doc_id", "size", "text_crc32")]
            made = [pa.array(np.full(n, part, np.int32)), *[pa.array(x.astype(np.int64)) for x in (arcs, before, rank, loads)]]
            yield pa.RecordBatch.from_arrays(
                [*kept, *made], ["doc_id", "size", "text_crc32", "part", "arc", "before", "rank", "load"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, size long, text_crc32 long, part int, arc long, before long, rank long, load long"
    ordered = docs.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id")
    return ordered.mapInArrow(run, schema)


def assign(docs: DataFrame, shards: int = SHARDS, law: str = "rows", virtual: int = VIRTUAL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot)`` of every row, balanced by ``rows`` or ``bytes``."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"law must be rows or bytes, not {law}")
    spark = docs.sparkSession
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    hashed = narrow(docs, doc_id=key, text=text).select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("place"),
    )
    places, owners = ring(shards, virtual)
    rows = materialize(_on_ring(materialize(hashed, "hashed"), places, law == "bytes"), "ring")

    # A range partition holds neighbouring arcs, so there are at most arcs plus partitions of these.
    sums = rows.groupBy("arc", "part").agg(F.sum("load").alias("load"), F.count("*").alias("n")).orderBy("arc", "part").collect()
    loads, counts, bases = np.zeros(len(owners), np.int64), np.zeros(len(owners), np.int64), []
    for r in sums:
        bases.append((r["arc"], r["part"], int(loads[r["arc"]]), int(counts[r["arc"]])))
        loads[r["arc"]] += r["load"]
        counts[r["arc"]] += r["n"]
    total = int(loads.sum())
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    parts = [(a, f, t, s, i) for i, (a, f, t, s) in enumerate(bounded(loads, owners, bounds))]

    bases_df = spark.createDataFrame(bases, "arc long, part int, base long, base_rows long")
    parts_df = spark.createDataFrame(parts, "arc long, from long, to long, shard int, cut long")
    placed = (
        rows.join(F.broadcast(bases_df), ["arc", "part"])
        .withColumn("at", F.col("base") + F.col("before"))
        .withColumn("rank", F.col("base_rows") + F.col("rank"))
        .join(F.broadcast(parts_df.withColumnRenamed("arc", "_arc")), F.expr("arc = _arc and at >= from and at < to"))
    )
    # Rows of one part are neighbours in their arc; a shard's slots go part by part.
    held = placed.groupBy("shard", "cut").agg(F.min("rank").alias("first"), F.count("*").alias("n")).orderBy("shard", "cut").collect()
    slots, filled = [], [0] * shards
    for r in held:
        slots.append((r["cut"], filled[r["shard"]] - r["first"]))
        filled[r["shard"]] += r["n"]
    slots_df = spark.createDataFrame(slots, "cut long, shift long")
    return placed.join(F.broadcast(slots_df), "cut").select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("rank") + F.col("shift")).alias("slot")
    )
