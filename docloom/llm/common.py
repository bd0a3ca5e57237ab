"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space that ends a word, [\x20\x09-\x0D]. bytes.split() cuts at exactly these.
WHITE = b" \t\n\x0b\x0c\r"

# What a task holds as Python values at once, as long as single rows are not larger.
PART_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: other columns cannot clash with ours."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, one value per row."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def parts(batches: Iterator[pa.RecordBatch], most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in parts of one row or of at most ``most`` bytes; nothing is copied.

    Spark ends a batch at 64 MiB. Python values of all its texts, and what is made of them, take several times that.
    """
    for batch in batches:
        waiting = [batch] if batch.num_rows else []
        while waiting:
            part = waiting.pop()
            if part.num_rows > 1 and part.nbytes > most:
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``make`` to each part of an Arrow batch; it gives the columns of ``schema`` by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield pa.RecordBatch.from_pydict(make(batch))

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, value by value."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.astype(np.uint64, copy=False).view(np.int64)
