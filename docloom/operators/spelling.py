"""Spelling suggestions from the words of an index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import words

MAX_DISTANCE = 2


def suggest(terms: DataFrame, words: Sequence[str], distance: int = MAX_DISTANCE) -> DataFrame:
    """``(word, suggestion, distance, df)`` for each query word that ``(term, df)`` lacks.

    The nearest term wins, then the more frequent, then the first by name. Terms are
    matched to words by length, and the query's words are the broadcast side: of the term
    table only near matches are shuffled.
    """
    spark = terms.sparkSession
    asked = spark.createDataFrame([(w,) for w in sorted({w.lower() for w in words})], "word string")
    lengths = F.sequence(F.length("word") - distance, F.length("word") + distance)
    by_length = asked.select("word", F.explode(lengths).alias("length"))
    near = (
        terms.withColumn("length", F.length("term"))
        .join(F.broadcast(by_length), "length")
        .withColumn("distance", F.levenshtein("term", "word", distance))
        .filter(F.col("distance") >= 0)
        .groupBy("word", "term", "distance")
        .agg(F.sum("df").alias("df"))
    )
    best = near.groupBy("word").agg(
        F.min(F.struct("distance", (-F.col("df")).alias("rare"), F.col("term").alias("suggestion"))).alias("best")
    )
    return best.filter(F.col("best")["distance"] > 0).select(
        "word",
        F.col("best")["suggestion"].alias("suggestion"),
        F.col("best")["distance"].alias("distance"),
        (-F.col("best")["rare"]).alias("df"),
    )


def corrected(query: str, suggestions: DataFrame) -> str:
    """The query with its misspelt words replaced, cut into words as the index cuts them."""
    best = {r["word"]: r["suggestion"] for r in suggestions.select("word", "suggestion").collect()}
    row = suggestions.sparkSession.range(1).select(words(F.lit(query)).alias("words")).first()
    rebuilt, rest = "", query
    for word in row["words"]:
        before, _, rest = rest.partition(word)
        rebuilt += before + best.get(word.lower(), word)
    return rebuilt + rest
