"""Token counts under a unigram vocabulary without making the tokens.

An Aho-Corasick automaton over the vocabulary gives, at each place of a word, all pieces that end
there. A dynamic programme carries two numbers from place to place: the best score of a split of the
word up to there, and the number of tokens of that split. Of equal scores the one whose last piece
begins first wins, as in the tokenizer, which goes through the places in order and replaces a split
only by a better one. A character that is no piece costs the least score minus ten and counts with
as many tokens as it has bytes (byte fallback).

The text is prepared as the tokenizer does it: spaces become U+2581, one is put before the text unless it
begins with one, and every U+2581 begins a word. So a word's count does not depend on its neighbours,
and words are counted once while they are in use. Words are of any length.

The vocabulary file at hand holds pieces and scores that are minus their merge ranks; they serve as the scores
of the unigram model. They are whole numbers, so sums are exact and ties do occur. Nothing is trained.

Defined cases: a null or empty text has no tokens. Rows with a null id and repeated rows are counted like any
other. Only the two named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from docloom.llm.common import map_batches, narrow

MARK = "▁"
# Fixed value: what a character outside the vocabulary costs beyond the least score.
UNKNOWN = 10.0

KEPT_LENGTH = 40
KEPT_ENTRIES = 400_000


class UnigramCounter:
    """Counts the tokens of texts under ``(piece, score)`` pairs."""

    def __init__(self, pieces: list[tuple[str, float]]):
        scores: dict[str, float] = {}
        for piece, score in pieces:
            scores[piece] = score  # of a piece that is listed twice the last entry counts
        self._unknown = min(scores.values()) - UNKNOWN
        self._single = {p for p in scores if len(p) == 1}
        self._automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._counts: dict[str, tuple[int, float]] = {}

    def split(self, word: str) -> tuple[int, float]:
        """The number of tokens and the score of the best split of one word."""
        n = len(word)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        single, unknown, at = self._single, self._unknown, 0

        def fall_back(end: int) -> None:
            """The split up to ``end`` so far, against one that ends in an unknown character."""
            last = word[end - 1]
            if last not in single:
                value = score[end - 1] + unknown
                if not count[end] or value > score[end]:
                    score[end], count[end] = value, count[end - 1] + len(last.encode("utf-8", "replace"))

        # Matches come by their end, the longest first: that is in the order of their beginnings.
        for last, (length, own) in self._automaton.iter(word):
            end = last + 1
            while at < end:
                if at:
                    fall_back(at)
                at += 1
            begin = end - length
            value = score[begin] + own
            if not count[end] or value > score[end]:
                score[end], count[end] = value, count[begin] + 1
        while at <= n:
            if at:
                fall_back(at)
            at += 1
        return count[n], score[n]

    def _word(self, word: str) -> tuple[int, float]:
        found = self._counts.get(word)
        if found is None:
            found = self.split(word)
            if len(word) <= KEPT_LENGTH:
                if len(self._counts) >= KEPT_ENTRIES:
                    self._counts.clear()
                self._counts[word] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        """The number of tokens and the score of a text."""
        if not text:
            return 0, 0.0
        text = text.replace(" ", MARK)
        first, *rest = (text if text[0] == MARK else MARK + text).split(MARK)
        tokens, score = 0, 0.0
        for word in rest:
            t, s = self._word(MARK + word)
            tokens += t
            score += s
        return tokens, score


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a model file in the order of their ids, with their scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


@lru_cache(maxsize=4)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(vocabulary(path))


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, score)`` of every document; ``path`` is a file that every executor can open."""
    rows = narrow(docs, doc_id=key, text=text)

    def run(batch: pa.RecordBatch) -> dict:
        found = [counter(path).count(t or "") for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array([n for n, _ in found], pa.int64()),
            "score": pa.array([s for _, s in found], pa.float64()),
        }

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, score double")
