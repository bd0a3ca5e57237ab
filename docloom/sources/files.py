"""Folder scan, name blacklist and archive expansion."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.paths import file_name, has_extension

# Names that are never ingested, whatever their case.
BLACKLIST = [".DS_Store", "Thumbs.db"]

RAW_SCHEMA = "path string, lang string, body binary"
EXPANDED_SCHEMA = "path string, lang string, body binary, status string"

# Bytes of entries handed back to Spark at a time, so that an archive much larger
# unpacked than packed never sits in memory as a whole.
_BATCH_BYTES = 16 * 1024 * 1024

_CHUNK_BYTES = 64 * 1024

# A Spark value cannot be larger; such an entry is reported with its size, not dropped.
MAX_BODY_BYTES = 2**31 - 1 - 1024

# The start of an entry in an archive, and its fields after the signature.
_LOCAL_HEADER = b"PK\x03\x04"
_LOCAL_FIELDS = "<HHHHHIIIHH"
_STORED, _DEFLATED = 0, 8
_ENCRYPTED, _SIZES_FOLLOW, _UTF8_NAME = 1, 8, 2048

# What a damaged archive or entry can raise: RuntimeError and NotImplementedError stand for
# encrypted entries and unknown compression.
_DAMAGE = (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError, OSError, ValueError, struct.error)


# File name patterns: names that end in .zip in any case, and all the others.
_ZIP_NAMES = "*.[zZ][iI][pP]"
_OTHER_NAMES = (
    "{*[^pP],*[^iI][pP],*[^zZ][iI][pP],*[^.][zZ][iI][pP],[pP],[iI][pP],[zZ][iI][pP]}"
)


def scan_files(spark: SparkSession, folder: str, names: str | None = None) -> DataFrame:
    """One ``(path, lang, body)`` row per file below ``folder``, blacklisted names left out.

    ``names`` is a file name pattern; files that do not match are not opened. Spark does not
    list files or folders whose names begin with ``.`` or ``_``; ``hidden_files`` counts them.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if names is not None:
        reader = reader.option("pathGlobFilter", names)
    files = reader.load(folder)
    named = files.select("path", F.lit("").alias("lang"), F.col("content").alias("body"))
    return drop_blacklisted(named)


def scan_expanded(spark: SparkSession, folder: str, filter_entries: bool = False) -> DataFrame:
    """Scan ``folder`` and open its archives: ``(path, lang, body, status)``.

    Archives and other files are told apart while listing, so every file is read once.
    """
    others = scan_files(spark, folder, _OTHER_NAMES).withColumn("status", F.lit("ok"))
    return others.unionByName(_expanded(scan_files(spark, folder, _ZIP_NAMES), filter_entries))


def hidden_files(spark: SparkSession, folder: str) -> int:
    """How many files ``scan_files`` leaves out because their or a folder's name begins with ``.`` or ``_``.

    Names are listed by the storage layer and counted on the driver one by one; none is kept.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    above, hidden = root.toUri().getPath().rstrip("/"), 0
    while files.hasNext():
        inside = files.next().getPath().toUri().getPath()[len(above) :]
        hidden += "/." in inside or "/_" in inside
    return hidden


def drop_blacklisted(df: DataFrame, path: str = "path") -> DataFrame:
    return df.filter(~F.lower(file_name(F.col(path))).isin([name.lower() for name in BLACKLIST]))


def expand_archives(df: DataFrame, filter_entries: bool = False) -> DataFrame:
    """Replace every zip row by one row per entry; nested zips are opened too.

    An entry's path is ``<path of its zip>/<entry name>``. An entry that cannot be read gives
    a row without body and with status ``corrupt``, or ``too_large:<bytes>`` if no value can
    hold it; an archive whose directory is missing gives one after the entries that its
    headers lead to. Only zip rows enter Python; the others stay in the JVM. The blacklist is not
    applied inside archives unless ``filter_entries`` is set.
    """
    is_zip = has_extension(F.col("path"), "zip")
    plain = df.filter(~is_zip).select("path", "lang", "body", F.lit("ok").alias("status"))
    return plain.unionByName(_expanded(df.filter(is_zip), filter_entries))


def _expanded(archives: DataFrame, filter_entries: bool) -> DataFrame:
    entries = archives.select("path", "body").mapInArrow(_expand_batches, EXPANDED_SCHEMA)
    return drop_blacklisted(entries) if filter_entries else entries


Entry = tuple[str, bytes | None, str]


def _entries(path: str, body: bytes) -> Iterator[Entry]:
    """``(path, body, status)`` of every entry, those of archives in the archive included, however deep.

    An archive met again within itself has no end and is ``corrupt``.
    """
    waiting, digests = [_opened(path, body)], [sha256(body).digest()]
    while waiting:
        row = next(waiting[-1], None)
        if row is None:
            waiting.pop()
            digests.pop()
        elif row[2] == "ok" and row[0].lower().endswith(".zip"):
            digest = sha256(row[1]).digest()
            if digest in digests:
                yield row[0], None, "corrupt"
            else:
                waiting.append(_opened(row[0], row[1]))
                digests.append(digest)
        else:
            yield row


def _opened(path: str, body: bytes) -> Iterator[Entry]:
    """The entries of one archive. A damaged one is ``corrupt``, those after it are read all the same."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(body))
    except _DAMAGE:
        yield from _streamed(path, body)
        return
    with archive:
        for entry in archive.infolist():
            if entry.is_dir():
                continue
            inner = f"{path}/{entry.filename}"
            if entry.file_size > MAX_BODY_BYTES:
                yield inner, None, f"too_large:{entry.file_size}"
                continue
            try:
                yield inner, archive.read(entry), "ok"
            except _DAMAGE:
                yield inner, None, "corrupt"


def _streamed(path: str, body: bytes) -> Iterator[Entry]:
    """The entries of an archive without its directory, from the headers in front of each.

    The archive itself is reported as ``corrupt`` after them.
    """
    whole, at = memoryview(body), body.find(_LOCAL_HEADER)
    while at >= 0:
        try:
            start = at + len(_LOCAL_HEADER)
            _, flags, method, _, _, check, packed, size, name_bytes, extra = struct.unpack_from(_LOCAL_FIELDS, body, start)
            start += struct.calcsize(_LOCAL_FIELDS)
            name = body[start : start + name_bytes].decode("utf-8" if flags & _UTF8_NAME else "cp437")
            start += name_bytes + extra
            if flags & _ENCRYPTED or method not in (_STORED, _DEFLATED) or method == _STORED and flags & _SIZES_FOLLOW:
                raise zipfile.BadZipFile("not readable without the directory")
            if method == _STORED:
                found, end = body[start : start + packed], start + packed
            else:
                # In chunks: handing over all that follows would copy the rest of the archive for each entry.
                reader, parts, end = zlib.decompressobj(-15), [], start
                while not reader.eof and end < len(body):
                    chunk = whole[end : end + _CHUNK_BYTES]
                    parts.append(reader.decompress(chunk))
                    end += len(chunk)
                if not reader.eof:
                    raise zipfile.BadZipFile("cut off")
                found, end = b"".join(parts), end - len(reader.unused_data)
            if not flags & _SIZES_FOLLOW and (len(found) != size or zlib.crc32(found) != check):
                raise zipfile.BadZipFile("does not match its checksum")
            if not name.endswith("/"):
                yield f"{path}/{name}", found, "ok"
        except _DAMAGE:
            end = at + len(_LOCAL_HEADER)
        at = body.find(_LOCAL_HEADER, end)
    yield path, None, "corrupt"


def _batch(rows: list[Entry]) -> pa.RecordBatch:
    paths, bodies, states = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(paths, pa.string()),
            pa.array([""] * len(rows), pa.string()),
            pa.array(bodies, pa.binary()),
            pa.array(states, pa.string()),
        ],
        names=["path", "lang", "body", "status"],
    )


def _expand_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[Entry] = []
    held = 0
    for batch in batches:
        for path, body in zip(batch.column(0), batch.column(1)):
            for row in _entries(path.as_py(), body.as_py() or b""):
                size = len(row[1] or b"")
                # Before a large one: a batch holds less than two gibibytes.
                if rows and held + size > _BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
                rows.append(row)
                held += size
    if rows:
        yield _batch(rows)
