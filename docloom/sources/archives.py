"""Archives of any size: their directory is read first, then their entries by many tasks.

``expand_archives`` opens an archive that is a value of a row. Here a task reads only the tail of an archive, where
the directory is, and plans byte ranges of its entries; the ranges are dealt out, and every task reads those it
got by seeking. So an archive may be larger than a Spark value, and a large one is read by many tasks. Files are opened
by Arrow, so they must be in a store that Arrow reads (local or mounted folders, S3, GCS, HDFS with its library).
"""

from __future__ import annotations

import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources import files as S

# Packed bytes of neighbouring entries that one task reads.
RANGE_BYTES = 64 * 1024 * 1024
_CHUNK = 1024 * 1024

# An entry as its archive's directory has it. ``name`` is null for an archive without a readable directory.
_PLANNED = "path string, name string, offset long, packed long, size long, crc long, method int, flags int, part long"
_NAMES = [field.split()[0] for field in _PLANNED.split(", ")]


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length)`` of the archives below ``folder``; none is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", S._ZIP_NAMES)
    return found.load(folder).select("path", "length")


def scan_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, filter_entries: bool = False) -> DataFrame:
    """The entries of all archives below ``folder``: ``(path, lang, body, status)`` as of ``expand_archives``."""
    return read_archives(archives(spark, folder), range_bytes, filter_entries)


def read_archives(found: DataFrame, range_bytes: int = RANGE_BYTES, filter_entries: bool = False) -> DataFrame:
    """The entries of the archives ``(path, length)``.

    Archives within an archive are opened where their entry is read. An archive without a readable directory is
    read from the headers of its entries, by one task, in chunks.
    """
    # One number: how many tasks the ranges are dealt over. The planned rows are small whatever they stand for.
    whole = found.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-whole // range_bytes))
    ranges = planned(found, range_bytes).repartition(tasks, "path", "part").sortWithinPartitions("path", "offset")
    entries = ranges.mapInArrow(_read_batches, S.EXPANDED_SCHEMA)
    return S.drop_blacklisted(entries) if filter_entries else entries


def planned(found: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row for every entry of the directories of ``(path, length)``, and the range ``part`` that it is in."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: list[tuple] = []
                for row in _directory(path, range_bytes):
                    rows.append((path, *row))
                    if len(rows) == 10_000:
                        yield _planned(rows)
                        rows = []
                yield _planned(rows)

    return found.select("path").mapInArrow(plan, _PLANNED)


def _planned(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.int32(), pa.int64()]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store that holds a path, and the path within it."""
    local = re.match(r"(?:file:/*)?(/.*)", path if "://" not in path or path.startswith("file:") else "")
    if local:
        return fs.LocalFileSystem(), "/" + local[1].lstrip("/")
    return fs.FileSystem.from_uri(path)


def opened(path: str) -> pa.NativeFile:
    """The file for reading at any place."""
    store, inside = store_of(path)
    return store.open_input_file(inside)


def _directory(path: str, range_bytes: int) -> Iterator[tuple]:
    """The entries in the directory of one archive, in the order of their places."""
    with opened(path) as body:
        try:
            found = sorted((e for e in zipfile.ZipFile(body).infolist() if not e.is_dir()), key=lambda e: e.header_offset)
        except S._DAMAGE:
            yield None, 0, body.size(), 0, 0, 0, 0, 0
            return
    for e in found:
        yield e.filename, e.header_offset, e.compress_size, e.file_size, e.CRC, e.compress_type, e.flag_bits, e.header_offset // range_bytes


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[S.Entry] = []
    held = 0
    for row in _rows(batches):
        size = len(row[1] or b"")
        if rows and held + size > S._BATCH_BYTES:
            yield S._batch(rows)
            rows, held = [], 0
        rows.append(row)
        held += size
    if rows:
        yield S._batch(rows)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[S.Entry]:
    path, body = None, None
    for batch in batches:
        for entry in batch.to_pylist():
            if entry["path"] != path:
                if body is not None:
                    body.close()
                path, body = entry["path"], opened(entry["path"])
            if entry["name"] is None:
                yield from _without_directory(path, body)
                continue
            inner = f"{path}/{entry['name']}"
            if entry["size"] > S.MAX_BODY_BYTES:
                yield inner, None, f"too_large:{entry['size']}"
                continue
            try:
                found = _read(body, entry)
            except S._DAMAGE:
                yield inner, None, "corrupt"
                continue
            if inner.lower().endswith(".zip"):
                yield from S._entries(inner, found)
            else:
                yield inner, found, "ok"
    if body is not None:
        body.close()


def _read(body: pa.NativeFile, entry: dict) -> bytes:
    """One entry, from its place to the end of its packed bytes."""
    if entry["flags"] & S._ENCRYPTED:
        raise zipfile.BadZipFile("encrypted")
    body.seek(entry["offset"])
    head = body.read(len(S._LOCAL_HEADER) + struct.calcsize(S._LOCAL_FIELDS))
    if head[: len(S._LOCAL_HEADER)] != S._LOCAL_HEADER:
        raise zipfile.BadZipFile("no entry at its place")
    *_, name_bytes, extra = struct.unpack_from(S._LOCAL_FIELDS, head, len(S._LOCAL_HEADER))
    body.seek(entry["offset"] + len(head) + name_bytes + extra)
    if entry["method"] == S._STORED:
        found = body.read(entry["packed"])
    elif entry["method"] == S._DEFLATED:
        reader, left, parts = zlib.decompressobj(-15), entry["packed"], []
        unpacked = 0
        while left and not reader.eof:
            chunk = body.read(min(_CHUNK, left))
            if not chunk:
                break
            left -= len(chunk)
            # No more than the directory says, so a damaged size cannot fill the memory.
            parts.append(reader.decompress(chunk, entry["size"] - unpacked + 1))
            unpacked += len(parts[-1])
            if unpacked > entry["size"]:
                break
        found = b"".join(parts)
    else:
        raise NotImplementedError("unknown compression")
    if len(found) != entry["size"] or zlib.crc32(found) != entry["crc"]:
        raise zipfile.BadZipFile("does not match its checksum")
    return found


def _without_directory(path: str, body: pa.NativeFile) -> Iterator[S.Entry]:
    """The entries that the headers lead to, searched for in windows that hold a header each."""
    size, at = body.size(), 0
    while at < size:
        body.seek(at)
        window = body.read(_CHUNK)
        found = window.find(S._LOCAL_HEADER)
        if found < 0:
            at += max(1, len(window) - len(S._LOCAL_HEADER) + 1)
            continue
        at += found
        row, end = _from_header(path, body, at, size)
        if row is not None:
            if row[2] == "ok" and row[0].lower().endswith(".zip"):
                yield from S._entries(row[0], row[1])
            else:
                yield row
        at = end
    yield path, None, "corrupt"


def _from_header(path: str, body: pa.NativeFile, at: int, size: int) -> tuple[S.Entry | None, int]:
    """The entry whose header is at a place, if it can be read, and where it ends."""
    after = at + len(S._LOCAL_HEADER)
    try:
        body.seek(after)
        head = body.read(struct.calcsize(S._LOCAL_FIELDS))
        _, flags, method, _, _, check, packed, length, name_bytes, extra = struct.unpack(S._LOCAL_FIELDS, head)
        name = body.read(name_bytes).decode("utf-8" if flags & S._UTF8_NAME else "cp437")
        start = after + len(head) + name_bytes + extra
        body.seek(start)
        if flags & S._ENCRYPTED or method not in (S._STORED, S._DEFLATED) or method == S._STORED and flags & S._SIZES_FOLLOW:
            return None, after
        if method == S._STORED:
            found, end = body.read(packed), start + packed
        else:
            reader, parts, unpacked, read = zlib.decompressobj(-15), [], 0, start
            while not reader.eof and unpacked <= S.MAX_BODY_BYTES and (chunk := body.read(_CHUNK)):
                parts.append(reader.decompress(chunk))
                unpacked += len(parts[-1])
                read += len(chunk)
            if not reader.eof:
                return None, after
            found, end = b"".join(parts), read - len(reader.unused_data)
        if not flags & S._SIZES_FOLLOW and (len(found) != length or zlib.crc32(found) != check):
            return None, after
    except S._DAMAGE:
        return None, after
    return (None if name.endswith("/") else (f"{path}/{name}", found, "ok")), end
