"""Writing tables: rolled files, results, bucketed copies."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame

from docloom.session import settings

# Fixed value: 128 MiB.
DEFAULT_TARGET_BYTES = 128 * 1024 * 1024


def _sizing(size: int) -> dict[str, str]:
    """Adaptive execution aims at ``size`` instead of at keeping all cores busy."""
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def target_bytes(size: int | str | None) -> int:
    """``size`` as a number of bytes; the default, with a warning, if it is no such number."""
    if size is None:
        return DEFAULT_TARGET_BYTES
    try:
        number = int(size)
    except ValueError:
        number = 0
    if number <= 0:
        warnings.warn(f"not a size in bytes: {size!r}; using {DEFAULT_TARGET_BYTES}", stacklevel=2)
        return DEFAULT_TARGET_BYTES
    return number


def pack_files(df: DataFrame, path: str, size: int | str | None = None, fmt: str = "parquet") -> None:
    """Write ``df`` as snappy files of about ``size`` bytes each; ``path`` must not exist.

    The rebalance step lets adaptive execution cut and merge its partitions by their real
    size, so no counting pass is needed, no file grows with the input and no task gets
    more than its share however uneven the input partitions are.
    """
    spark = df.sparkSession
    with settings(spark, _sizing(target_bytes(size))):
        df.hint("rebalance").write.format(fmt).option("compression", "snappy").mode("errorifexists").save(path)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a result. Refuses to write over an existing folder unless told otherwise."""
    df.write.format(fmt).mode(mode).save(path)


def save_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str] = ("path",), mode: str = "errorifexists"
) -> DataFrame:
    """Write ``df`` as a catalog table hashed into buckets by ``keys``.

    Joins and word counts keyed by ``path`` then need no shuffle of the large text column.
    Rows are brought together by bucket first, so each bucket is one file, not one per task.
    """
    first, *rest = keys
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .mode(mode)
        .option("path", path)
        .bucketBy(buckets, first, *rest)
        .sortBy(first, *rest)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
