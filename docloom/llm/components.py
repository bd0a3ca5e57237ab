"""Connected components of an edge table, by contraction in a random order of the vertices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize


def _shuffled(vertex: Column) -> Column:
    """A one-to-one map of the 64-bit integers (xorshift), so that ids in sequence are no long chains."""
    for _ in range(2):
        vertex = vertex.bitwiseXOR(F.shiftleft(vertex, 13))
        vertex = vertex.bitwiseXOR(F.shiftrightunsigned(vertex, 7))
        vertex = vertex.bitwiseXOR(F.shiftleft(vertex, 17))
    return vertex


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every vertex with an edge; ``component`` is the smallest id it can reach.

    A round points each vertex at its least neighbour, follows pointers twice, and puts the targets
    in place of the vertices; edges within a target vanish. It ends when no edge is left, after a
    number of rounds that grows with the logarithm of the number of vertices. Every round works on
    written tables, so a lost executor costs one round at most.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    pairs = materialize(pairs, "edges")
    vertices = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    roots = vertices.select("id", _shuffled(F.col("id")).alias("root"))
    links = pairs.select(_shuffled(F.col("a")).alias("u"), _shuffled(F.col("b")).alias("v"))
    while not links.isEmpty():
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        least = materialize(least, "pointers")
        on = least.select(F.col("u").alias("p"), F.col("p").alias("f"))
        moved = materialize(least.join(on, "p").select("u", "f"), "targets")
        links = links.join(moved, "u").select(F.col("f").alias("x"), "v")
        links = links.join(moved.select(F.col("u").alias("v"), F.col("f").alias("y")), "v").where("x <> y")
        links = materialize(links.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), "links")
        following = moved.select(F.col("u").alias("root"), F.col("f").alias("next"))
        roots = roots.join(following, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    roots = materialize(roots, "roots")
    smallest = roots.groupBy("root").agg(F.min("id").alias("component"))
    return materialize(roots.join(smallest, "root").select("id", "component"), "components")
