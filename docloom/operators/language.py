"""Language detection with letter-trigram profiles.

A profile holds the share of each frequent trigram in one language's text, as in
W. Cavnar and J. Trenkle, N-gram-based text categorization, 1994. A text belongs to the
profile nearest to its own trigram shares. The squared distance between profile ``p`` and
text ``q`` is ``sum(p*p) - 2*sum(p*q) + sum(q*q)``. The last term is the same for every
language and ``sum(p*q)`` is the mean of ``p`` over the text's trigrams, so a text is scored
in one streaming pass, without counting its trigrams first. Whole Arrow batches of texts are
scored where they are read: one row out for each row in, and no shuffle.

Shares are whole numbers per million: sums are exact and do not depend on their order.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as T

PROFILE_SIZE = 1000
MILLION = 1_000_000

# Characters scored at a time: memory depends neither on the rows of a batch nor on the length of a text.
PIECE = 1 << 18
# Rows of a batch that are Python strings at a time.
ROWS = 500

# Squared distance by which the best language must lead to count as reasonably certain.
# Measured on labelled text: nearly all texts of a few words or more lead by more, and
# most wrong answers by less.
GATE = 0.002


def trigram_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per trigram of each text. A text without letters gives one row with null."""
    by_word = df.select(*keep, F.explode_outer(T.letter_words(F.col(text))).alias("_word"))
    return by_word.select(*keep, F.explode_outer(T.word_trigrams(F.col("_word"))).alias("gram"))


def profiles(labelled: DataFrame, text: str = "body", lang: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """``(lang, gram, pf)``: the ``size`` most frequent trigrams of each language.

    ``pf`` is the trigram's share in the language's text, per million. Each task first
    counts its own trigrams, so what is shuffled is a few thousand rows per task, and the
    ranking cuts each task's share to ``size`` rows before it moves them.
    """
    grams = trigram_rows(labelled, text, lang).filter(F.col("gram").isNotNull())
    counts = grams.groupBy(lang, "gram").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(lang).alias("_lang")).agg(F.sum("n").alias("total"))
    order = Window.partitionBy(lang).orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    share = F.floor(F.col("n") * F.lit(MILLION) / F.col("total") + F.lit(0.5)).cast("long")
    return top.join(totals, F.col(lang) == F.col("_lang")).select(
        F.col(lang).alias("lang"), "gram", share.alias("pf")
    )


@dataclass(frozen=True)
class Weights:
    """Trigram codes in order, a row of weights for each of them, and the languages' norms and names."""

    codes: np.ndarray
    values: np.ndarray
    norms: np.ndarray
    names: list[str]

    def decide(self, texts: Sequence[str | None], min_margin: float | None = None) -> list[str]:
        """The language of each text, by the rules of ``LanguageModel.detect``."""
        rows, languages = len(texts), len(self.names)
        if not rows or not languages:
            return [""] * rows
        letters, sums = np.zeros(rows, np.int64), np.zeros((rows, languages))
        for first, pieces in _pieces(texts):
            self._add(pieces, letters[first:], sums[first:])
        with np.errstate(divide="ignore", invalid="ignore"):
            distances = self.norms - 2.0 * MILLION * sums / letters[:, None]
        certain = letters > 0
        best = np.argmin(np.where(certain[:, None], distances, 0), axis=1)
        if min_margin is not None and languages > 1:
            first, second = np.partition(np.where(certain[:, None], distances, 0), 1, axis=1)[:, :2].T
            certain &= second - first >= min_margin * MILLION**2
        return [self.names[b] if c else "" for b, c in zip(best, certain)]

    def _add(self, pieces: list[tuple[int, str]], letters: np.ndarray, sums: np.ndarray) -> None:
        """Add the letters and the weights of the trigrams of ``(row, piece)``, but for those round a piece's two ends."""
        coded = [piece.encode("utf-32-le", "replace") for _, piece in pieces]
        lengths = np.array([len(c) // 4 for c in coded])
        points = np.frombuffer(b"".join(coded), dtype=np.uint32).astype(np.int64)
        row = np.repeat(np.array([r for r, _ in pieces]), lengths)
        letter = _is_letter()[points]
        inner, ends = letter.copy(), np.cumsum(lengths)
        inner[ends - lengths] = inner[ends - 1] = False
        rows = int(row[-1]) + 1
        letters[:rows] += np.bincount(row[inner], minlength=rows)
        # Any other character is "_", as are the blanks at both ends of a text. A trigram around a letter is then
        # one of the padded words' own.
        points = np.where(letter, points, ord("_"))
        middle = np.flatnonzero(inner)
        grams = points[middle - 1] << 42 | points[middle] << 21 | points[middle + 1]
        place = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
        known = self.codes[place] == grams
        place, row = place[known], row[middle][known]
        # Sums of whole numbers far below 2**53, so exact.
        for i in range(len(self.names)):
            sums[:rows, i] += np.bincount(row, self.values[place, i], rows)


@dataclass(frozen=True)
class LanguageModel:
    """Profiles in the form scoring needs, sent to each executor once."""

    weights: Broadcast[Weights]

    @staticmethod
    def fit(labelled: DataFrame, text: str = "body", lang: str = "lang", size: int = PROFILE_SIZE) -> LanguageModel:
        return LanguageModel.from_profiles(profiles(labelled, text, lang, size))

    @staticmethod
    def from_profiles(table: DataFrame) -> LanguageModel:
        """The model of a table ``(lang, gram, pf)``: ``size`` rows for each language, however many texts."""
        found = table.select("lang", "gram", "pf").orderBy("lang", "gram").toPandas()
        names = sorted(set(found["lang"]))
        number = {name: i for i, name in enumerate(names)}
        codes, place = np.unique(np.array([_code(g) for g in found["gram"]], dtype=np.int64), return_inverse=True)
        values = np.zeros((len(codes), len(names)), np.int64)
        values[place, [number[name] for name in found["lang"]]] = found["pf"]
        made = Weights(codes, values, (values**2).sum(axis=0).astype(np.float64), names)
        return LanguageModel(table.sparkSession.sparkContext.broadcast(made))

    @property
    def languages(self) -> list[str]:
        return self.weights.value.names

    def detect(
        self, df: DataFrame, text: str = "body", key: str = "path", min_margin: float | None = None
    ) -> DataFrame:
        """``(key, lang)``, one row for every row.

        The nearest language wins, the first by name among equals. With ``min_margin`` it
        must beat the next one by that much in squared distance, else ``lang`` is ``''``. A
        text without any letter has no language in either mode.
        """
        weights = self.weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, ROWS) for i in range(0, len(batch), ROWS)):
                    found = weights.value.decide(part.column(1).to_pylist(), min_margin)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string())], [key, "lang"])

        kind = df.schema[key].dataType.simpleString()
        return df.select(F.col(key), F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, lang string")

    def udf(self, min_margin: float | None = None):
        """The same decision as a vectorised function, for when the text has to stay in its row."""
        weights = self.weights

        @F.pandas_udf("string")
        def language(texts: pd.Series) -> pd.Series:
            return pd.Series(weights.value.decide(texts.tolist(), min_margin), dtype=object)

        return language

    def column(self, text: Column, min_margin: float | None = None) -> Column:
        return self.udf(min_margin)(text)

    def register(self, spark: SparkSession, name: str = "detect_lang", min_margin: float | None = None) -> None:
        """Make ``udf`` callable from SQL."""
        spark.udf.register(name, self.udf(min_margin))


def _pieces(texts: Sequence[str | None], size: int = PIECE) -> Iterator[tuple[int, list[tuple[int, str]]]]:
    """The first row and the pieces ``(row, piece)``, rows counted from it, of about ``size`` characters of the texts.

    Texts are in lower case between two blanks. A longer one is in several pieces, each with the character
    before and the character after its own.
    """
    first, pieces, held = 0, [], 0
    for number, text in enumerate(texts):
        padded = f" {text.lower()} " if text else ""
        for start in range(1, len(padded) - 1, size):
            if not pieces:
                first = number
            pieces.append((number - first, padded[start - 1 : start + size + 1]))
            held += len(pieces[-1][1])
            if held >= size:
                yield first, pieces
                pieces, held = [], 0
    if pieces:
        yield first, pieces


def _code(gram: str) -> int:
    a, b, c = (ord(ch) for ch in gram)
    return a << 42 | b << 21 | c


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once in a Python worker."""
    return np.array([unicodedata.category(chr(p)).startswith("L") for p in range(sys.maxunicode + 1)])
