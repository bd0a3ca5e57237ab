"""Word counts, document frequency and TF-IDF on exact words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators.joins import lookup_join
from docloom.session import materialize


def tokenize(df: DataFrame, ngrams: Sequence[int] = ()) -> DataFrame:
    """``(path, body)`` to ``(path, words)``. ``ngrams=(2, 3)`` adds the shingles."""
    single = df.select("path", T.words(F.col("body")).alias("words"))
    if not ngrams:
        return single
    return single.select(
        "path", F.concat("words", *[T.shingles(F.col("words"), n) for n in ngrams]).alias("words")
    )


def wordcount(words: DataFrame) -> DataFrame:
    """``(path, words)`` to ``(f, w, c)``, the count ``c`` of word ``w`` in file ``f``.

    A file's words sit in one task, so the partial count before the shuffle already
    leaves one row per file and word. On a table bucketed by path there is no shuffle.
    """
    exploded = T.each(words, "words", F.col("path").alias("f"), name="w")
    return exploded.groupBy("f", "w").agg(F.count(F.lit(1)).alias("c"))


def doc_freq(words: DataFrame) -> DataFrame:
    """``(w, df)``: in how many documents a word occurs.

    Repeats are removed inside each row, so one shuffle of partial counts is enough.
    """
    distinct = T.each(words, F.array_distinct("words"), name="w")
    return distinct.groupBy("w").agg(F.count(F.lit(1)).alias("df"))


def idf(frequency: DataFrame, documents: Column) -> DataFrame:
    """``(w, df, idf)`` with ``idf = ln((N + 1) / (df + 1))`` over all ``N`` documents."""
    return frequency.withColumn("idf", F.log((documents + F.lit(1.0)) / (F.col("df") + F.lit(1.0))))


def tfidf(words: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``(f, w, c, df, tfidf)`` for every word of every file.

    Give ``counts``, the stored result of ``wordcount``, to keep the texts from being cut up
    again: the words' document frequency then comes from that table as well. Both are stored on the way if
    they are not given.
    """
    documents = words.agg(F.count(F.lit(1))).scalar()
    if counts is None:
        counts, frequency = materialize(wordcount(words), "wordcount"), doc_freq(words)
    else:
        frequency = counts.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    frequency = materialize(frequency, "frequency")
    weighted = lookup_join(counts, idf(frequency, documents), key="w", weight="df")
    return weighted.select("f", "w", "c", "df", (F.col("c") * F.col("idf")).alias("tfidf"))
