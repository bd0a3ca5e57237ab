"""Line dedup: a line that several documents hold stays in the one with the smallest id only.

1. Every task folds the hashes of its documents' lines into two Bloom filters: the bits of keys
   seen once, and the bits of keys it has seen twice. Only non-empty segments of 32 KiB leave it.
2. Segments of the same place meet: a bit is in the merged second filter if any task saw it
   twice, or if two tasks saw it once. A key held by two documents has all its bits there.
3. Only keys with all bits in the second filter are suspected. Their digests of 128 bits are
   shuffled with the document's id; a key with two different ids is a repeat, and the smallest
   id keeps its lines.
4. Documents without a suspected key are finished where they are read. Only the others are
   shuffled, to meet the list of keys that they lose.

The second filter is broadcast. It has 128 bits for each document, at most ``max_bits``, so
16 MiB by default: beyond that more keys are suspected, the result stays the same.

Defined cases: a null or empty text is one empty line and gives an empty text. Keys of fewer than
``least_chars`` code points never go. Rows that share an id are one document. Rows with a null id
neither make a line a repeat nor lose any. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.common import WHITE, column_bytes, mix, narrow, parts
from docloom.session import materialize

LEAST_CHARS = 10
BITS_PER_DOCUMENT = 128
MAX_BITS = 1 << 27
SEGMENT_BITS = 1 << 18
_HASHES = 2


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(WHITE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode("utf-8", "replace")) >= least)


def _keys(text: bytes | None, least: int) -> set[bytes]:
    return {k for k in map(line_key, (text or b"").split(b"\n")) if _long_enough(k, least)}


def _hashed(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class Bits:
    """A filter's bits, eight to a byte, read and set by arrays of positions like an array of booleans."""

    def __init__(self, bits: int):
        self._bits, self._bytes = bits, np.zeros(-(-bits // 8), np.uint8)

    def __len__(self) -> int:
        return self._bits

    def __getitem__(self, positions: np.ndarray) -> np.ndarray:
        return (self._bytes[positions >> 3] >> (7 - (positions & 7)).astype(np.uint8) & 1).astype(bool)

    def __setitem__(self, positions: np.ndarray, value: bool) -> None:
        if not value:
            raise ValueError("bits are only set")
        positions = np.unique(positions)
        if len(positions):
            places, first = np.unique(positions >> 3, return_index=True)
            self._bytes[places] |= np.bitwise_or.reduceat(np.left_shift(1, 7 - (positions & 7)).astype(np.uint8), first)

    def packed(self, begin: int, end: int) -> np.ndarray:
        """The bytes of the bits from ``begin`` to before ``end``, both multiples of eight."""
        return self._bytes[begin // 8 : end // 8]


def _positions(hashed: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash in a filter: a row per hash function."""
    return np.stack([mix(hashed + np.uint64(i)) & np.uint64(bits - 1) for i in range(_HASHES)]).astype(np.int64)


def _fold(once: np.ndarray, twice: np.ndarray, hashed: np.ndarray) -> None:
    """Add the keys of some documents, each at most once per document, to a pair of filters."""
    found, counts = np.unique(hashed, return_counts=True)
    positions = _positions(found, len(once))
    seen = np.all(once[positions], axis=0) | (counts > 1)
    twice[positions[:, seen]] = True
    once[positions] = True


def _filters(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """``(segment, once, twice)`` of each task, the two as compressed bits."""
    segment = min(bits, SEGMENT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bits(bits), Bits(bits)
        for batch in parts(batches):
            keys = [k for t, i in zip(column_bytes(batch, "text"), batch.column("doc_id").is_valid().to_pylist()) if i for k in _keys(t, least)]
            if keys:
                _fold(once, twice, _hashed(keys))
        for s in range(bits // segment):
            bounds = s * segment, (s + 1) * segment
            if once.packed(*bounds).any():
                packed = [zlib.compress(f.packed(*bounds).tobytes(), 1) for f in (once, twice)]
                yield pa.RecordBatch.from_pydict(
                    {"segment": pa.array([s], pa.int32()), "once": [packed[0]], "twice": [packed[1]]}
                )

    return docs.mapInArrow(run, "segment int, once binary, twice binary")


def _merged(filters: DataFrame, bits: int) -> DataFrame:
    """``(segment, twice)``: the segments of the merged second filter."""
    size = min(bits, SEGMENT_BITS) // 8

    def bitmap(packed: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(packed), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for batch in batches:
            for one, two in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
                seen = bitmap(one)
                twice |= bitmap(two) | (once & seen)
                once |= seen
            segment = batch.column("segment")[:1]
        if twice.any():
            yield pa.RecordBatch.from_arrays([segment, pa.array([zlib.compress(twice.tobytes(), 1)])], ["segment", "twice"])

    return filters.groupBy("segment").applyInArrow(_typed(run), "segment int, twice binary")


def _typed(run):
    """Spark tells the streaming form of applyInArrow by its annotations."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)

    merged.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return merged


def filter_bits(documents: int, max_bits: int = MAX_BITS) -> int:
    """The size of a filter: a power of two by the number of documents, within bounds."""
    return min(max_bits, max(1 << 16, 1 << (BITS_PER_DOCUMENT * documents - 1).bit_length()))


class LineDedup:
    """The repeated lines of a table of documents, found once and applied to it by ``rows``."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, max_bits: int = MAX_BITS):
        self._docs, self._key, self._text, self._least = docs, key, text, least_chars
        spark = docs.sparkSession
        rows = self._narrow = narrow(docs, doc_id=key, text=text)
        self._id_type = dict(rows.dtypes)["doc_id"]
        bits = filter_bits(docs.count(), max_bits)
        size = min(bits, SEGMENT_BITS)
        # At most max_bits / 8 bytes, whatever the table.
        segments = _merged(_filters(rows, bits, least_chars), bits).collect()
        twice = {r["segment"]: zlib.decompress(r["twice"]) for r in segments}
        blank = bytes(size // 8)
        self._bits = bits
        self._twice = spark.sparkContext.broadcast(b"".join(twice.get(s, blank) for s in range(bits // size)))
        self._drops = self._find(rows)

    def _suspects(self):
        bits, twice, least = self._bits, self._twice, self._least

        def suspects(texts: list[bytes | None]) -> list[list[bytes]]:
            """The suspected keys of each text."""
            packed = np.frombuffer(twice.value, np.uint8)
            keys = [list(_keys(t, least)) for t in texts]
            flat = [k for ks in keys for k in ks]
            positions = _positions(_hashed(flat), bits)
            hit = np.all(packed[positions >> 3] >> (7 - (positions & 7)).astype(np.uint8) & 1, axis=0)
            found, at = [], 0
            for ks in keys:
                found.append([k for k, h in zip(ks, hit[at : at + len(ks)]) if h])
                at += len(ks)
            return found

        return suspects

    def _find(self, rows: DataFrame) -> DataFrame:
        """``(_id, _keys)``: the digests of the keys that a document loses."""
        suspects = self._suspects()

        def run(batches):
            for batch in parts(batches):
                batch = batch.filter(batch.column("doc_id").is_valid())
                found = suspects(column_bytes(batch, "text"))
                at = [i for i, ks in enumerate(found) for _ in ks]
                digests = [xxhash.xxh3_128_digest(k) for ks in found for k in ks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), batch.column("doc_id").take(pa.array(at, pa.int64()))], ["digest", "doc_id"]
                )

        held = materialize(rows.mapInArrow(run, f"digest binary, doc_id {self._id_type}"), "suspects")
        repeats = (
            held.groupBy("digest")
            .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
            .where(F.col("first") != F.col("last"))
            .select(F.col("digest").alias("repeat"), "first")
        )
        lost = held.join(repeats, F.col("digest") == F.col("repeat")).where(F.col("doc_id") != F.col("first"))
        return materialize(lost.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("digest").alias("_keys")), "drops")

    def rows(self) -> DataFrame:
        """All rows and columns of the table with the text that is left."""
        return self._finish(self._docs, self._key, self._text, False)

    def counted(self) -> DataFrame:
        """``(doc_id, text, n_lines, n_dropped)``: what is left, lines before and lines dropped."""
        return self._finish(self._narrow, "doc_id", "text", True)

    def _finish(self, docs: DataFrame, key: str, text: str, counts: bool) -> DataFrame:
        least, suspects = self._least, self._suspects()
        key_at, text_at = docs.columns.index(key), docs.columns.index(text)
        numbers = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
        schema = T.StructType(docs.schema.fields + numbers * counts)

        def texts(batch: pa.RecordBatch) -> list[bytes | None]:
            return batch.column(text_at).cast(pa.binary()).to_pylist()

        def finish(batch: pa.RecordBatch, drops: list) -> pa.RecordBatch:
            left, lines, dropped = [], [], []
            for t, lost in zip(texts(batch), drops):
                kept = split = (t or b"").split(b"\n")
                if lost:
                    lost = set(lost)
                    kept = [x for x in split if not (_long_enough(k := line_key(x), least) and xxhash.xxh3_128_digest(k) in lost)]
                left.append(b"\n".join(kept) if len(kept) < len(split) else t or b"")
                lines.append(len(split))
                dropped.append(len(split) - len(kept))
            columns = batch.columns[: len(docs_names)]
            columns[text_at] = pa.array(left, pa.binary()).cast(pa.string())
            extra = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())] if counts else []
            return pa.RecordBatch.from_arrays(columns + extra, docs_names + ["n_lines", "n_dropped"] * counts)

        docs_names = docs.columns

        def suspected(batch: pa.RecordBatch) -> pa.Array:
            known = batch.column(key_at).is_valid().to_pylist()
            return pa.array([bool(s) and k for s, k in zip(suspects(texts(batch)), known)], pa.bool_())

        def clear(batches):
            for batch in parts(batches):
                batch = batch.filter(pc.invert(suspected(batch)))
                yield finish(batch, [None] * batch.num_rows)

        def unclear(batches):
            for batch in parts(batches):
                yield batch.filter(suspected(batch))

        def rewrite(batches):
            for batch in parts(batches):
                yield finish(batch, batch.column(batch.num_columns - 1).to_pylist())

        # Under a name that no column has; it is told apart by its place afterwards.
        keys = "_".join(["_keys", *docs_names])
        drops = self._drops.select(F.col("_id"), F.col("_keys").alias(keys))
        waiting = docs.mapInArrow(unclear, docs.schema)
        met = waiting.join(drops, waiting[key] == drops["_id"], "left")
        met = met.select(*[waiting[f"`{n}`"] for n in docs_names], drops[keys])
        return docs.mapInArrow(clear, schema).union(met.mapInArrow(rewrite, schema))
