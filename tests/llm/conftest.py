from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

LONG = "strap lines of a long text without end " * 3000

# Nulls in every column, empty and blank texts, a very long text and a very long word, copies, repeated rows.
AWKWARD = [
    (1, "One line of text here\nsecond line of it\n\nOne line of text here", "en", "a", 5),
    (2, "  ONE LINE of text here \nsomething else entirely", None, None, None),
    (3, None, "en", "a", 0),
    (4, "", "en", "a", 0),
    (5, " \t\n ", "de", "b", 4),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + "tail", "en", "b", None),
    (8, "x" * 30_000, "en", "b", 30_000),
    (9, "é漢😀 it's 12,5 <|endoftext|> naïve space\x00", "fr", "c", 7),
    (9, "é漢😀 it's 12,5 <|endoftext|> naïve space\x00", "fr", "c", 7),
    (None, "One line of text here", "en", "a", 21),
    (12, "word", "en", "a", 4),
    (13, "WORD", "en", "a", 4),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with all awkward cases and columns named like those the operators make."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(AWKWARD, DOCUMENTS)
    for name in ("ids", "kept", "shard", "n_lines", "_keys", "_gone", "component_id", "part", "rank", "digest", "length"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
