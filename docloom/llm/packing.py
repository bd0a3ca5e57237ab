"""Token pieces and their packing into sequences by bounded-space online best fit.

A packer keeps a fixed number of open sequences. They hang in lists by their free space, and a
bitset has a bit for each free space that occurs. A piece goes to the open sequence with the least
free space that still holds it: the lowest bit at or above its length. If none does, a new
sequence is opened, and if too many are open the fullest is closed, that of the lowest bit.

Pieces arrive in windows of four times the number of open sequences, the longest of a window first:
in windows much larger than that, sequences would close before the short pieces come.

Pieces are packed by tasks of about ``rows_per_task`` narrow rows each, a hundred times the open
sequences: one task sees enough pieces to fill its sequences whatever the number of files, and the
number of tasks follows the table. Only (id, piece, start, length) and the
checksum move; a task holds the open sequences and nothing else.

Defined cases: a null text is an empty text, which is one piece of one token, the end mark.
Documents of more than ``capacity`` tokens are cut into pieces of ``capacity``, the last one may be
shorter; no other document is cut. Repeated rows are packed as often as they occur, null ids like
any other. Only the two named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from docloom.llm.common import column_bytes, narrow, parts
from docloom.session import materialize

CAPACITY = 4096
OPEN = 1024
ROWS_PER_TASK = 100_000
END = 1

# Words found in many texts are encoded once; neither of the two tables of words grows beyond this. A worker
# keeps them from task to task, about 300 bytes an entry.
KEPT_LENGTH = 40
KEPT_ENTRIES = 200_000

_MARKS = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())


class WordEncoder:
    """Ids of texts under a vocabulary whose tokens never reach over white space.

    So a text is cut at ASCII white space and each part is encoded once. Marks at the end of a part,
    after a letter, begin a pre-token of their own and are looked up apart: ``word,`` is ``word``
    and ``,``. The normaliser lower-cases, so A-Z are lower-cased before the look-up.

    With ``added_tokens`` the exact name of an added token, such as ``<|endoftext|>``, is that token, as
    the library has it by default. Otherwise it is ordinary text.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder() if added_tokens else {}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("only added tokens that are found by their exact name are supported")
        self._added = {t.content.encode(): np.array([i], "<u4").tobytes() for i, t in added.items()}
        names = b"|".join(re.escape(name) for name in sorted(self._added, key=len, reverse=True))
        self._cut = re.compile(b"(" + names + b")").split if names else lambda text: [text]
        self._tokenizer.encode_special_tokens = True  # what is left of their names after the cut is ordinary text
        self._model = self._tokenizer.model
        self._parts: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _ids(self, part: bytes) -> bytes:
        if part.isalpha() or part and not part.strip(_MARKS):  # ASCII letters, or ASCII marks: one pre-token
            ids = [t.id for t in self._model.tokenize(part.decode())]
        else:
            ids = self._tokenizer.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _part(self, part: bytes) -> bytes:
        found = self._parts.get(part)
        if found is None:
            found = self._older.get(part)
        if found is None:
            word = part.rstrip(_MARKS)
            # The last character as the normaliser leaves it: one letter may become a letter and a mark.
            if word and len(word) < len(part) and word.decode("utf-8", "replace")[-1].lower()[-1].isalpha():
                found = self._part(word) + self._part(part[len(word) :])
            else:
                found = self._ids(part)
            if len(part) > KEPT_LENGTH:
                return found
        if len(self._parts) >= KEPT_ENTRIES:
            self._parts, self._older = {}, self._parts
        self._parts[part] = found
        return found

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, part, added = self._parts.get, self._part, self._added
        cut = self._cut(text)
        if len(cut) == 1:
            return b"".join([known(p) or part(p) for p in text.lower().split()])
        return b"".join([b"".join([part(p) for p in c.lower().split()]) if i % 2 == 0 else added[c] for i, c in enumerate(cut)])


@lru_cache(maxsize=4)
def encoder(path: str, added_tokens: bool = False) -> WordEncoder:
    return WordEncoder(path, added_tokens)


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, key: str = "doc_id", text: str = "text", added_tokens: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: every document's ids and the end mark, cut at ``capacity``.

    ``ids`` are packed as little-endian unsigned 32-bit integers. ``path`` is a tokenizer file that
    every executor can open, ``added_tokens`` as in ``WordEncoder``.
    """
    rows = narrow(docs, doc_id=key, text=text)
    mark = np.array([end], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            at, piece, start, ids = [], [], [], []
            for row, t in enumerate(column_bytes(batch, "text")):
                whole = encoder(path, added_tokens).encode(t or b"") + mark
                for number, begin in enumerate(range(0, len(whole), step)):
                    at.append(row)
                    piece.append(number)
                    start.append(begin // 4)
                    ids.append(whole[begin : begin + step])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(at, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array([len(i) // 4 for i in ids], pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


class Packer:
    """Bounded-space online best fit."""

    def __init__(self, capacity: int, most_open: int):
        self._capacity, self._most = capacity, most_open
        self._free = 0  # bit f: some open sequence has f free places
        self._lists: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._open = 0
        self._opened = 0

    def _take(self, free: int) -> int:
        sequences = self._lists[free]
        sequence = sequences.pop()
        if not sequences:
            self._free ^= 1 << free
        self._open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """The sequence for a piece of 1 to ``capacity`` tokens and the place of its first token."""
        fitting = self._free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self._open >= self._most:
                self._take((self._free & -self._free).bit_length() - 1)  # the fullest closes
            free, sequence = self._capacity, self._opened
            self._opened += 1
        left = free - length
        if left:
            if not self._lists[left]:
                self._free |= 1 << left
            self._lists[left].append(sequence)
            self._open += 1
        return sequence, self._capacity - free


def pack(rows: DataFrame, capacity: int = CAPACITY, most_open: int = OPEN, rows_per_task: int = ROWS_PER_TASK, length: str = "length") -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset`` added; every length is from 1 to ``capacity``.

    ``rows`` should be a written table: it is counted, then dealt out evenly without a key.
    """
    names = rows.columns
    at, window = names.index(length), 4 * most_open

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer, first = Packer(capacity, most_open), TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column(at).to_numpy(zero_copy_only=False)
            placed = np.empty((len(lengths), 2), np.int64)
            for begin in range(0, len(lengths), window):
                longest_first = begin + np.argsort(-lengths[begin : begin + window], kind="stable")
                placed[longest_first] = [packer.place(n) for n in lengths[longest_first].tolist()]
            made = [pa.array(first + placed[:, 0]), pa.array(placed[:, 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*names, "sequence_id", "offset"])

    tasks = max(1, -(-rows.count() // rows_per_task))
    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    # The same order in every attempt of a task, and one that does not follow ids or lengths.
    dealt = rows.repartition(tasks).sortWithinPartitions(F.xxhash64(*[F.col(f"`{n}`") for n in names]), f"`{length}`")
    return dealt.mapInArrow(run, T.StructType(rows.schema.fields + added))


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, most_open: int = OPEN, key: str = "doc_id", text: str = "text", added_tokens: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all pieces of all documents."""
    cut = pieces(docs, path, capacity, key=key, text=text, added_tokens=added_tokens).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(materialize(cut, "pieces"), capacity, most_open)
