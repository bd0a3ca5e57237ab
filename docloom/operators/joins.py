"""Joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many heavy keys are broadcast. Whatever the data, a key that is not among
# the n heaviest holds less than 1/n of the rows.
HEAVY_KEYS = 1024


def lookup_join(rows: DataFrame, dimension: DataFrame, key: str, weight: str, heavy: int = HEAVY_KEYS) -> DataFrame:
    """Left join of ``rows`` with a ``dimension`` that has one row per string ``key``.

    ``weight`` is the dimension's column saying how often a key occurs in ``rows``. The
    ``heavy`` most frequent keys are answered from a broadcast of exactly that many rows.
    Rows so answered stay where they are: only the others go to the shuffle join. ``rows`` is
    read for each of the two, so it is best a stored table.
    """
    values = [c for c in dimension.columns if c != key]
    top = dimension.orderBy(F.desc(weight), key).limit(heavy)
    top = F.broadcast(top.select(F.col(key).alias("_k"), *[F.col(v).alias(f"_{v}") for v in values]))
    rest = dimension.select(F.col(key).alias("_k"), *[F.col(v).alias(f"_{v}") for v in values])
    same = F.col(key) == F.col("_k")
    others = rows.join(top, same, "left_anti").join(rest, same, "left")
    joined = rows.join(top, same).unionByName(others)
    return joined.select(*rows.columns, *[F.col(f"_{v}").alias(v) for v in values])
