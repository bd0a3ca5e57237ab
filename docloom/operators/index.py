"""The search index: document rows and the word postings made from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.paths import doc_id, path_words
from docloom.session import materialize

# What a document gets when no language or cluster table is given.
NO_LANGUAGE = ""
NO_CLUSTER = -1

# Fixed value: rows per call of a caller-supplied sender.
SEND_BATCH = 100

# The languages that get a text field of their own.
ROUTED = ["fr", "en"]

FIELDS = ["text", "path"]
BUCKETS = 64
SHARD_CHARS = 2
# Of an index's tables: texts and places are most of what is written.
COMPRESSION = "zstd"

# Documents of a word in one row of a block table, and words grouped at a time.
BLOCK = 32
GROUPED = 1 << 22

BLOCK_SCHEMA = "field string, term string, n int, first bigint, packed array<smallint>, wide array<int>"
# Numbers of documents that differ above this bit are not in one block: their differences are integers.
NEAR_BITS = 31
# The numbers of the documents of different versions do not meet.
VERSION_NUMBERS = 1 << 53
NO_NUMBER = -1
# The folder's name of a version that is stored without the language fields.
LEFT_OUT = "w"


def with_defaults(parsed: DataFrame, use_parsed_lang: bool = False) -> DataFrame:
    """The parsed columns with constant ``lang`` and ``cluster``."""
    lang = F.col("lang") if use_parsed_lang else F.lit(NO_LANGUAGE)
    return parsed.select(
        "path", "fileName", "extension", "body", lang.alias("lang"), F.lit(NO_CLUSTER).alias("cluster")
    )


def enrich(docs: DataFrame, lang: DataFrame | None = None, clusters: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Join documents with their languages and clusters on ``path``.

    With ``how="inner"`` a document missing from a given table is dropped, and one that a
    table lists twice comes out twice. ``how="left"`` keeps the missing ones with the
    default values. The narrow tables are joined with each other first: the wide document
    rows then move at most once, in a single join that adaptive execution can broadcast
    or split where one path is heavy.
    """
    if lang is None and clusters is None:
        return docs
    sides, replaced = [], []
    if lang is not None:
        sides.append(lang.select("path", F.col("lang").alias("_lang")))
        replaced.append("lang")
    if clusters is not None:
        sides.append(clusters.select("path", F.col("cluster").cast("int").alias("_cluster")))
        replaced.append("cluster")
    facts = sides[0]
    if len(sides) == 2:
        facts = facts.join(sides[1], "path", "inner" if how == "inner" else "full")
    joined = docs.join(facts, "path", how)
    columns = [
        (F.coalesce(f"_{c}", c) if how == "left" else F.col(f"_{c}")).alias(c) if c in replaced else F.col(c)
        for c in docs.columns
    ]
    return joined.select(*columns)


def routed_text(lang: Column, body: Column, code: str) -> Column:
    """The text when the language is ``code`` in either case, else null."""
    return F.when(F.lower(lang) == code, body)


def with_routed_text(rows: DataFrame) -> DataFrame:
    """Add the language fields, which repeat the text of French and English documents."""
    fields = {f"text_{code}": routed_text(F.col("lang"), F.col("text"), code) for code in ROUTED}
    return rows.withColumns(fields)


def index_documents(
    parsed: DataFrame,
    lang: DataFrame | None = None,
    clusters: DataFrame | None = None,
    how: str = "inner",
    use_parsed_lang: bool = False,
) -> DataFrame:
    """Parsed documents to index rows."""
    docs = enrich(with_defaults(parsed, use_parsed_lang), lang, clusters, how)
    rows = docs.select(
        doc_id(F.col("path")).alias("id"), "path", "fileName", "lang", F.col("body").alias("text"), "extension", "cluster"
    )
    return with_routed_text(rows)


def _without_routed_text(rows: DataFrame) -> DataFrame:
    """For a shuffle: the language fields are made again afterwards."""
    return rows.drop(*[f"text_{code}" for code in ROUTED])


def _as(docs: DataFrame, rows: DataFrame, *more: str) -> DataFrame:
    """``rows`` with the columns of ``docs``, the language fields put back if it has them."""
    whole = with_routed_text(rows) if set(docs.columns) - set(rows.columns) else rows
    return whole.select(*docs.columns, *more)


def latest(docs: DataFrame, version: Column | None = None) -> DataFrame:
    """One index row per id, the one with the highest ``version``.

    Each task first cuts its own rows to one per id, so an id that is written over and
    over does not gather in one place. Without a version, or among equal ones, the
    greatest row wins, so that the outcome does not depend on the order of the rows.
    """
    rows = _without_routed_text(docs)
    newest = F.max(F.struct((version if version is not None else F.lit(0)).alias("_v"), *rows.columns)).alias("_row")
    kept = rows.groupBy("id").agg(newest)
    return _as(docs, kept.select(*[F.col("_row")[c].alias(c) for c in rows.columns]))


def shard(id_column: Column, chars: int = SHARD_CHARS) -> Column:
    """The folder of an id, after its first characters. Ids are hashes, so folders are even.

    The leading letter keeps a name such as ``00`` from being read back as a number.
    """
    return F.concat(F.lit("s"), F.substring(id_column, 1, chars))


def write_index(
    docs: DataFrame, path: str, mode: str = "errorifexists", shard_chars: int = SHARD_CHARS, first_number: int | None = None
) -> None:
    """Write index rows into one folder per shard; sizes are evened out while writing.

    With ``first_number`` each row gets a number of its own, ``num``, from there on, with gaps; one without
    an id gets ``NO_NUMBER``.
    """
    moved = _without_routed_text(docs).withColumn("shard", shard(F.col("id"), shard_chars)).hint("rebalance", "shard")
    rows = _as(docs, moved, "shard")
    if first_number is not None:
        number = F.lit(first_number) + F.monotonically_increasing_id()
        rows = rows.withColumn("num", F.when(F.col("id").isNull(), NO_NUMBER).otherwise(number))
    (
        rows.write.partitionBy("shard")
        .mode(mode)
        .option("compression", COMPRESSION)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def upsert_index(batch: DataFrame, path: str, shard_chars: int = SHARD_CHARS) -> None:
    """Add a batch to written index rows. A row replaces the stored one with the same id.

    For rows alone; an ``Index``, whose words must follow, has ``update``.

    Only the shards that the batch touches are read and rewritten. Their names are
    collected: 16 to the power of ``shard_chars`` at most.
    """
    stored = batch.sparkSession.read.parquet(path)
    touched = [r[0] for r in batch.select(shard(F.col("id"), shard_chars)).distinct().collect()]
    old = stored.filter(F.col("shard").isin(touched)).select(*batch.columns, F.lit(0).alias("_version"))
    both = old.unionByName(batch.withColumn("_version", F.lit(1)))
    write_index(latest(both, F.col("_version")).drop("_version"), path, "overwrite", shard_chars)


def push_documents(docs: DataFrame, sender: Callable[[], Callable[[list[Row]], None]], batch_size: int = SEND_BATCH) -> None:
    """Hand all rows to an outside system, ``batch_size`` at a time.

    ``sender`` is called once per partition, in the task, and gives the function that
    sends one batch. A retried task sends its batches again; as rows carry their id, the
    receiver just writes them over.
    """

    def run(rows: Iterable[Row]) -> None:
        send = sender()
        for batch in batched(rows, batch_size):
            send(batch)

    docs.foreachPartition(run)


def batched(rows: Iterable[Row], size: int) -> Iterator[list[Row]]:
    source = iter(rows)
    while batch := list(islice(source, size)):
        yield batch


def blocks(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, field, term, n, first, packed, wide)``: words with ``n`` of their documents, ``BLOCK`` at most.

    Takes ``(num, text, path)``. ``first`` is the number of the first document: an id of 32 bytes is most of a posting. ``packed``
    has, for one document after the other, how far its number is from ``first``, then how often each has the word, then the length
    of each one's field, kept here so that ranking needs no join for it, then how many positions stand before its own, then all
    positions; it is null and ``wide`` has them if a value takes more than two bytes. Most words are rare: arrays for each of these
    would be most of a block of one document.
    A document's words are all in its row, so they are grouped where they are, some rows at a time, and what is shuffled and
    sorted later is blocks.
    """
    fields = F.array(
        F.struct(F.lit("text").alias("field"), T.terms(F.col("text")).alias("terms")),
        F.struct(F.lit("path").alias("field"), T.terms(path_words(F.col("path"))).alias("terms")),
    )
    by_field = docs.select(F.col("num").alias("doc"), F.inline(fields))
    grouped = by_field.mapInArrow(_group_words, BLOCK_SCHEMA)
    return grouped.select(bucket(F.col("term"), buckets).alias("bucket"), *grouped.columns)


def entries(found: DataFrame) -> DataFrame:
    """Blocks to postings ``(bucket, field, term, doc, tf, dl, positions)``, one row per document, field and word."""
    whole = found.withColumn("packed", F.coalesce("wide", F.col("packed").cast("array<int>")))
    n, first, packed = F.col("n"), F.col("first"), F.col("packed")

    def entry(i: Column) -> Column:
        tf = F.get(packed, n + i)
        return F.struct(
            (first + F.get(packed, i)).alias("doc"),
            tf.cast("long").alias("tf"),
            F.get(packed, n * 2 + i).alias("dl"),
            F.slice(packed, n * 4 + F.get(packed, n * 3 + i) + 1, tf).alias("positions"),
        )

    return whole.select("bucket", "field", "term", F.inline(F.transform(F.sequence(F.lit(0), n - 1), entry)))


def _group_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``(doc, field, terms)`` to blocks."""
    # Rows with about GROUPED words together: memory does not grow with the rows of a batch or the batches of a task.
    held, words = [], 0
    for batch in batches:
        lengths = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
        part = (words + np.cumsum(lengths, dtype=np.int64)) // GROUPED
        cuts = [0, *(np.flatnonzero(np.diff(part, prepend=0)) + 1).tolist()]
        for start, end in zip(cuts, cuts[1:]):
            held.append(batch.slice(start, end - start))
            yield from _grouped(held)
            held, words = [], 0
        if cuts[-1] < len(lengths):
            held.append(batch.slice(cuts[-1]))
            words += int(lengths[cuts[-1] :].sum())
    yield from _grouped(held)


def _grouped(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pa.Table.from_batches(batches).combine_chunks().to_batches() if batches else []:
        if len(batch.column("terms").flatten()):
            yield _blocks(batch)


def _blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = batch.column("terms")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
    coded, fields = lists.flatten().dictionary_encode(), batch.column("field").dictionary_encode()
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    word = coded.indices.to_numpy(zero_copy_only=False) * np.int32(len(fields.dictionary))
    word += fields.indices.to_numpy(zero_copy_only=False)[row]
    order = np.argsort(word, kind="stable")  # rows and positions ascend as they are
    begun = np.cumsum(lengths, dtype=np.int64) - lengths
    word, row = word[order], row[order]
    position = (order - begun[row]).astype(np.int32)
    # One entry per word, field and row, then blocks of entries of one word and field with numbers near each other.
    starts = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    word, rows = word[starts], row[starts]
    tf = np.diff(np.append(starts, len(order)))
    doc = batch.column("doc").to_numpy(zero_copy_only=False)[rows]
    new = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(doc >> NEAR_BITS, prepend=0) != 0))
    place = np.arange(len(word)) - np.repeat(new, np.diff(np.append(new, len(word))))
    heads = np.flatnonzero(place % BLOCK == 0)
    n = np.diff(np.append(heads, len(word)))
    # Where each block's values begin: four for each entry, then its positions.
    ends = np.cumsum(4 * n + np.add.reduceat(tf, heads))
    begin = np.append(0, ends[:-1])
    packed = np.empty(int(ends[-1]), np.int32)
    at = np.repeat(begin, n) + np.arange(len(word)) - np.repeat(heads, n)
    before = starts - np.repeat(starts[heads], n)
    for i, values in enumerate((doc - np.repeat(doc[heads], n), tf, lengths[rows], before)):
        packed[at + i * np.repeat(n, n)] = values
    packed[np.repeat(np.repeat(begin + 4 * n, n) + before - starts, tf) + np.arange(len(order))] = position
    two = (np.maximum.reduceat(packed, begin) < 1 << 15) & (np.minimum.reduceat(packed, begin) >= 0)
    return pa.RecordBatch.from_arrays(
        [
            fields.dictionary.take(pa.array(word[heads] % len(fields.dictionary))),
            coded.dictionary.take(pa.array(word[heads] // len(fields.dictionary))),
            pa.array(n.astype(np.int32)),
            pa.array(doc[heads]),
            _lists(packed, ends - begin, two, np.int16),
            _lists(packed, ends - begin, ~two, np.int32),
        ],
        names=["field", "term", "n", "first", "packed", "wide"],
    )


def _lists(values: np.ndarray, sizes: np.ndarray, taken: np.ndarray, kind: type) -> pa.ListArray:
    """The lists that are ``taken``, null in the place of the others."""
    offsets = np.append(0, np.cumsum(np.where(taken, sizes, 0))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[np.repeat(taken, sizes)].astype(kind)), mask=pa.array(~taken))


def bucket(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Index:
    """The tables of a written index.

    ``documents`` has the index rows by shard, each with a number ``num``, ``postings`` the words by
    bucket with the numbers of their documents, ``terms`` each word's document frequency, ``stats`` one row per field.

    An index is a row of versions, each a folder with these four tables. The first holds all
    documents; each later one holds a batch of new and changed documents, and in ``terms`` and
    ``stats`` the differences it makes. Rows of a document that a later version holds are passed over
    when reading. A version counts once its number is in the list ``versions``, which is the last
    thing written, so a job that fails on the way leaves the index as it was.
    """

    documents: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    buckets: int = BUCKETS
    shard_chars: int = SHARD_CHARS
    path: str = ""
    version: int = 0

    @staticmethod
    def build(
        docs: DataFrame,
        path: str,
        buckets: int = BUCKETS,
        shard_chars: int = SHARD_CHARS,
        unique_ids: bool = False,
    ) -> Index:
        """Write the index below ``path``. ``unique_ids`` says that no id occurs twice.

        Words go to folders by hash, and in a folder to files by ranges of words: a query
        opens the folders of its words, and there the file or two that have the word. A
        very common word spreads over as many files as it needs.
        """
        spark = docs.sparkSession
        name = _write_version(docs, path, 0, buckets, shard_chars, unique_ids)
        _commit(spark, path, 0, name, "errorifexists")
        return Index.open(spark, path, buckets, shard_chars)

    @staticmethod
    def open(spark: SparkSession, path: str, buckets: int = BUCKETS, shard_chars: int = SHARD_CHARS) -> Index:
        """The newest state; ``buckets`` and ``shard_chars`` as the index was built."""
        versions = _versions(spark, path)
        tables = [[spark.read.parquet(f"{path}/{name}/{t}") for _, name in versions] for t in ("documents", "postings", "terms", "stats")]
        documents, words, terms, stats = tables
        documents = [_with_left_out(d) if name.startswith(LEFT_OUT) else d for d, (_, name) in zip(documents, versions)]
        if len(versions) > 1:
            ids = [d.select("id") for d in documents]
            terms = [_all(terms).groupBy("bucket", "field", "term").agg(F.sum("df").alias("df")).filter(F.col("df") > 0)]
            stats = [_all(stats).groupBy("field").agg(F.sum("total_len").alias("total_len"), F.max("n_docs").alias("n_docs"))]
            hidden = [d.join(_all(ids[v + 1 :]), "id", "left_semi") for v, d in enumerate(documents[:-1])]
            words = [_without(words, [h.select(F.col("num").alias("doc")) for h in hidden], "doc")]
            documents = [_without(documents, [_all(ids[v + 1 :]) for v in range(len(ids) - 1)], "id")]
        return Index(documents[0], words[0], terms[0], stats[0], buckets, shard_chars, path, versions[-1][0])

    def update(self, batch: DataFrame) -> Index:
        """The index with a batch of rows added; a row replaces the one with the same id.

        Written is what the batch brings. Of the rest only the documents that it replaces are read,
        to take their words out of the counts.
        """
        spark, version = batch.sparkSession, self.version + 1
        name = _write_version(batch, self.path, version, self.buckets, self.shard_chars, False, self)
        _commit(spark, self.path, version, name, "append")
        return Index.open(spark, self.path, self.buckets, self.shard_chars)

    def compact(self, path: str) -> Index:
        """The same documents as an index of one version at a new place."""
        docs = self.documents.drop("shard", "num")
        return Index.build(docs, path, self.buckets, self.shard_chars, unique_ids=True)


def _all(tables: list[DataFrame]) -> DataFrame:
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first


def _without(tables: list[DataFrame], hidden: list[DataFrame], key: str) -> DataFrame:
    """The rows of all versions, those of each but the last without the keys hidden there."""
    kept = [t.join(h, key, "left_anti") for t, h in zip(tables, hidden)]
    columns = tables[0].columns
    return _all([t.select(*columns) for t in [*kept, tables[-1]]])


def _with_left_out(stored: DataFrame) -> DataFrame:
    """Stored documents with the language fields, which are made of the text as it is read."""
    own = [c for c in stored.columns if c not in ("num", "shard")]
    return with_routed_text(stored).select(*own, *[f"text_{code}" for code in ROUTED], "num", "shard")


def _gone(spark: SparkSession, path: str, before: Index, stored: DataFrame) -> DataFrame:
    """``(bucket, field, term, total, n)``, less than zero, of the documents that ``stored`` replaces.

    From their postings, which are in the order of the words, so neither texts nor postings move. Which documents they
    are is sent to the executors at a bit a document, in rows for 32,768 numbers.
    """
    replaced = before.documents.select("shard", "id", "num").join(stored.select("shard", "id"), ["shard", "id"], "left_semi")
    bits = replaced.groupBy(F.bitmap_bucket_number("num").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("num")).alias("bits")
    )
    words = _all([spark.read.parquet(f"{path}/{name}/postings") for _, name in _versions(spark, path)])
    place = F.bitmap_bit_position("doc")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = words.withColumn("part", F.bitmap_bucket_number("doc")).join(F.broadcast(bits), "part")
    gone = found.filter(F.getbit(byte, (place % 8).cast("int")) == 1)
    return gone.select("bucket", "field", "term", (-F.col("tf")).alias("total"), F.lit(-1).cast("long").alias("n"))


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    return sorted((r["version"], r["name"]) for r in spark.read.parquet(f"{path}/versions").collect())


def _commit(spark: SparkSession, path: str, version: int, name: str, mode: str) -> None:
    row = spark.range(version, version + 1, 1, 1).select(F.col("id").alias("version"), F.lit(name).alias("name"))
    row.write.mode(mode).parquet(f"{path}/versions")


def _write_version(
    docs: DataFrame, path: str, version: int, buckets: int, shard_chars: int, unique_ids: bool, before: Index | None = None
) -> str:
    """The four tables of one version; with ``before`` their counts are differences to it. Gives its folder's name."""
    routed = [f"text_{code}" for code in ROUTED]
    left_out = {"lang", "text", *routed} <= set(docs.columns)
    name = f"{LEFT_OUT if left_out else 'v'}{version}-{uuid.uuid4().hex}"
    spark, folder = docs.sparkSession, f"{path}/{name}"
    unique = docs if unique_ids else _one_per_id(docs)
    unique = _without_routed_text(unique) if left_out else unique
    write_index(unique, f"{folder}/documents", shard_chars=shard_chars, first_number=version * VERSION_NUMBERS)
    stored = spark.read.parquet(f"{folder}/documents")
    # Ranges are found by a sample, for which texts are cut once more: written on the way, blocks would be as large as the postings.
    _write_by_bucket(blocks(stored, buckets), f"{folder}/postings", "first", made=entries)
    # Counted in the order of the words: a task has hardly a word that another has too.
    postings = spark.read.parquet(f"{folder}/postings")
    words = postings.select("bucket", "field", "term", F.col("tf").alias("total"), F.lit(1).cast("long").alias("n"))
    documents = stored.agg(F.count(F.lit(1))).scalar()
    if before is not None:
        words = words.unionByName(_gone(spark, path, before, stored))
        documents = documents + before.documents.join(stored.select("shard", "id"), ["shard", "id"], "left_anti").agg(
            F.count(F.lit(1))
        ).scalar()
    counts = words.groupBy("bucket", "field", "term").agg(F.sum("n").alias("df"), F.sum("total").alias("total"))
    counts = materialize(counts, "counts")
    _write_by_bucket(counts.filter(F.col("df") != 0).select("bucket", "field", "term", "df"), f"{folder}/terms")
    lengths = counts.groupBy("field").agg(F.sum("total").alias("total_len"))
    lengths.select("field", "total_len", documents.alias("n_docs")).write.parquet(f"{folder}/stats")
    return name


def _one_per_id(docs: DataFrame) -> DataFrame:
    """``latest`` where an id occurs twice. Ids are looked at by themselves first, so that unique rows do not move for it."""
    repeated = docs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return docs if repeated.isEmpty() else latest(docs)


def _write_by_bucket(df: DataFrame, path: str, *more: str, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """By ranges of word and, for a word with many rows, of ``more``: a word is in few files. Written is what is ``made`` of the rows."""
    order = ["bucket", "term", "field", *more]
    made(df.repartitionByRange(*order).sortWithinPartitions(*order)).write.partitionBy("bucket").parquet(path, compression=COMPRESSION)
