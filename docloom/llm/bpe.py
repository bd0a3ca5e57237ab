"""Byte-level BPE: encoding with a rank queue, decoding by table.

The merges of one pre-token are ordered by a queue over merge ranks. Each rank has a bucket of
positions in a linked list of parts; a bitmap of three levels of 64-bit words tells which buckets
hold anything, so the least rank is found by three find-first-set steps whatever the length of
the pre-token. A bucket gives its leftmost position first. Merging does not remove the entries
of the pairs it destroys: an entry whose pair has another rank by now is stale and is skipped.

Defined cases: a null text is an empty text, it has no ids and decodes to no bytes. Every byte is
a token of its own, so any text can be encoded, and decoding gives back its UTF-8 bytes. Rows with
a null id column and repeated rows are encoded like any other. Only the two named columns are
read, so further columns of any name do not matter. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from docloom.llm.common import narrow

# Longer strings are rare and are not kept; a cache has two generations of this many entries at most.
KEPT_LENGTH = 40
KEPT_WORDS = 500_000
KEPT_CHUNKS = 300_000
# Rows of a batch that are worked on together: the ids of a long batch would be larger than its texts.
ROWS_AT_ONCE = 512

# Fixed value: the pattern of the vocabularies at hand, under which a space only ever begins a
# pre-token or is white space. The two shortcuts below hold for it; other patterns go without.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space, a space, then white space or the end: only there can cutting a text at its spaces
# change how the pattern matches, as it decides about a run of white space by what follows it.
_CUT_MATTERS = re.compile(r"\s (?:\s|\Z)").search
# ASCII letters, then ASCII marks: two pre-tokens under SPACED, without matching it.
_PLAIN = re.compile(r"( ?[A-Za-z]+)([!-/:-@\[-`{-~]*)").fullmatch


class Recent(dict):
    """Values made by ``make`` for short keys, kept while in use: two generations of bounded size."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self._make, self._most, self._older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
            if len(key) > KEPT_LENGTH:
                return value
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class RankQueue:
    """Positions by merge rank, least rank first, leftmost position first within a rank.

    ``top`` has a bit for each word of ``words``, which has a bit for each rank with a bucket. A
    bucket is one position, or a heap of them once it holds more.
    """

    def __init__(self, ranks: int):
        self.top = 0
        self.words = [0] * ((ranks >> 8) + 1)
        self.buckets: dict[int, int | list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        held = self.buckets.get(rank)
        if held is None:
            self.buckets[rank] = position
            word = rank >> 8
            if not self.words[word]:
                self.top |= 1 << word
            self.words[word] |= 1 << (rank & 255)
        elif held.__class__ is int:
            self.buckets[rank] = [held, position] if held < position else [position, held]
        else:
            heappush(held, position)

    def pop(self) -> tuple[int, int]:
        """The least rank and its leftmost position; only while ``top`` is not zero."""
        top, words = self.top, self.words
        word = (top & -top).bit_length() - 1
        bits = words[word]
        low = bits & -bits
        rank = word << 8 | low.bit_length() - 1
        held = self.buckets[rank]
        if held.__class__ is int:
            position = held
        else:
            position = heappop(held)
            if held:
                return rank, position
        del self.buckets[rank]
        words[word] = bits = bits ^ low
        if not bits:
            self.top = top & (top - 1)
        return rank, position


class BytePairCodec:
    """Encodes and decodes with the ranks of a vocabulary and a pattern that makes pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks = ranks
        self._findall = regex.compile(pattern).findall
        self._by_spaces = pattern == SPACED
        self._queue = RankQueue(max(ranks.values()) + 1)
        self._tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._tokens[rank] = token
        self._words = Recent(lambda word: np.array(self.merge(word.encode()), "<u4").tobytes(), KEPT_WORDS)
        self._chunks = Recent(self._cut, KEPT_CHUNKS)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        rank_of = self._ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n, queue = len(piece), self._queue
        push, pop = queue.push, queue.pop
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends, and the next starts
        before = list(range(-1, n))  # before[i]: start of the part before the one that starts at i
        pair = [rank_of(piece[i : i + 2]) for i in range(n)]
        pair[-1] = None
        for i, rank in enumerate(pair):
            if rank is not None:
                push(rank, i)
        while queue.top:
            rank, i = pop()
            if pair[i] != rank:
                continue  # stale
            middle = end[i]
            stop = end[i] = end[middle]
            pair[middle] = pair[i] = None
            if stop < n:
                before[stop] = i
                rank = rank_of(piece[i : end[stop]])
                if rank is not None:
                    pair[i] = rank
                    push(rank, i)
            if i:
                left = before[i]
                pair[left] = rank = rank_of(piece[left:stop])
                if rank is not None:
                    push(rank, left)
        ids, i = [], 0
        while i < n:
            ids.append(self._ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def _cut(self, chunk: str) -> bytes:
        words = self._words
        plain = _PLAIN(chunk)
        if plain:
            word, marks = plain.groups()
            return words[word] + words[marks] if marks else words[word]
        return b"".join([words[w] for w in self._findall(chunk)])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers.

        A text is cut before each space and the parts are looked up whole. Where that could
        change the pre-tokens the pattern goes over the text itself.
        """
        if not self._by_spaces or _CUT_MATTERS(text):
            words = self._words
            return b"".join([words[w] for w in self._findall(text)])
        first, *rest = text.split(" ")
        chunks = self._chunks
        return chunks[first] + b"".join([chunks[" " + r] for r in rest])

    def decode(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(map(self._tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> BytePairCodec:
    """The codec of a file of ranks, read once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return BytePairCodec(ranks, pattern)


def _made(df: DataFrame, column: str, out: list[str], make: Callable[[object], tuple[bytes, ...]]) -> DataFrame:
    """``(doc_id, *out)``: binary columns made from the values of ``column``."""
    schema = f"doc_id {dict(df.dtypes)['doc_id']}, " + ", ".join(f"{o} binary" for o in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                rows = [make(v) for v in part.column(column).to_pylist()]
                made = [pa.array(c, pa.binary()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made], ["doc_id", *out])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)``: ids packed as little-endian unsigned 32-bit integers, no special tokens.

    ``path`` is a file of ranks that every executor can open, ``pattern`` makes the pre-tokens.
    """
    return _made(narrow(docs, doc_id=key, text=text), "text", ["ids"], lambda t: (codec(path, pattern).encode(t or ""),))


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, bytes)``: what packed ids stand for; null ids stand for nothing."""
    return _made(narrow(encoded, doc_id=key, ids=ids), "ids", ["bytes"], lambda i: (codec(path, pattern).decode(i or b""),))


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids, bytes)``: the ids of ``encode`` and what ``decode`` makes of them, in one pass."""

    def both(t: str | None) -> tuple[bytes, bytes]:
        ids = codec(path, pattern).encode(t or "")
        return ids, codec(path, pattern).decode(ids)

    return _made(narrow(docs, doc_id=key, text=text), "text", ["ids", "bytes"], both)
