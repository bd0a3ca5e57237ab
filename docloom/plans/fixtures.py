"""The views over the given tables that the registered queries run on."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.index import Index, index_documents
from docloom.operators.language import LanguageModel
from docloom.operators.parse import with_file_facts
from docloom.session import materialize, scratch_path
from docloom.sources.archives import store_of

_kept: dict[tuple[str, str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, make):
    """``make()``, done once per application and folder: for models and written indexes."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def document_path() -> Column:
    """``/<source>/<doc_id><extension>``; one document in five has no extension."""
    extension = (
        F.when(F.col("doc_id") % 5 == 0, ".txt")
        .when(F.col("doc_id") % 5 == 1, ".TXT")
        .when(F.col("doc_id") % 5 == 2, ".md")
        .when(F.col("doc_id") % 5 == 3, ".log")
        .otherwise("")
    )
    return F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), extension)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, body, doc_id, lang, source, n_chars)`` of every document."""
    return table(spark, sf_dir, "documents").select(
        document_path().alias("path"), F.col("text").alias("body"), "doc_id", "lang", "source", "n_chars"
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, body)`` of every document, for the steps that cut the text up."""
    return docs(spark, sf_dir).select("path", "body")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, body)`` of every page."""
    path = F.concat(
        F.regexp_replace("url", "[?#].*", ""), F.lit("/"), F.col("page_id").cast("string"), F.lit(".html")
    )
    return table(spark, sf_dir, "pages").select(path.alias("path"), F.col("html").alias("body"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, body)`` of every turn of a conversation, named as a format without a reader."""
    path = F.format_string("/chat/%d/%d.docx", "conv_id", "turn")
    return table(spark, sf_dir, "conversations").select(path.alias("path"), F.col("text").alias("body"))


def raw_files(spark: SparkSession, sf_dir: str, *views) -> DataFrame:
    """``(path, lang, body binary)`` of the rows of all the views."""
    made = [
        v(spark, sf_dir).select("path", F.lit("").alias("lang"), F.encode("body", "UTF-8").alias("body"))
        for v in views
    ]
    all_rows = made[0]
    for more in made[1:]:
        all_rows = all_rows.unionByName(more)
    return all_rows


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed documents whose ``lang`` was found while parsing."""
    return with_file_facts(docs(spark, sf_dir).select("path", "body", "lang"))


def lang_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, lang)`` of the documents with a label; the others have no language."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs(spark, sf_dir).select("path", "lang", "doc_id").join(labels, "doc_id").select("path", "lang")


def cluster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, cluster)`` of the documents with an embedding, whose label is the cluster."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return (
        docs(spark, sf_dir)
        .select("path", "doc_id")
        .join(vectors, "doc_id")
        .select("path", F.col("label").cast("int").alias("cluster"))
    )


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows of all documents, with the default cluster where none is known.

    The clusters are written first: Catalyst then knows their size, and texts move for the join only if they have to.
    """
    clusters = materialize(cluster_table(spark, sf_dir), "clusters")
    return index_documents(parsed(spark, sf_dir), clusters=clusters, how="left", use_parsed_lang=True)


def index(spark: SparkSession, sf_dir: str) -> Index:
    return once(
        spark, sf_dir, "index", lambda: Index.build(index_rows(spark, sf_dir), scratch_path(spark, "index"), 8, 1)
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a label, which are the training set of the language model."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs(spark, sf_dir).join(labels, "doc_id").select("body", "lang")


def language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    return once(spark, sf_dir, "language", lambda: LanguageModel.fit(labelled(spark, sf_dir)))


def zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document packed alone: ``<path>.ZIP`` with the text, and a zip with it once more."""
    return texts(spark, sf_dir).mapInArrow(_zip, "path string, lang string, body binary")


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [f"{p}.ZIP" for p in batch.column(0).to_pylist()]
        bodies = []
        for text in batch.column(1).to_pylist():
            inner, outer = io.BytesIO(), io.BytesIO()
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("copy.md", text)
            with zipfile.ZipFile(outer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("folder/", "")
                archive.writestr("folder/text.txt", text)
                archive.writestr("inner.zip", inner.getvalue())
            bodies.append(outer.getvalue())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths), pa.array([""] * len(paths)), pa.array(bodies, pa.binary())], names=["path", "lang", "body"]
        )


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple[str, str]]]:
    """The rows in groups of about ``size`` characters."""
    rows, held = [], 0
    for batch in batches:
        for path, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append((path, body))
            held += len(body)
            if held >= size:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def archived(spark: SparkSession, sf_dir: str, archive_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """``(path, length)`` of archives of all documents in the shared folder, each made by a task as it comes to it."""
    folder = scratch_path(spark, "archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inside = store_of(folder)
        store.create_dir(inside)
        for rows in _groups(batches, archive_bytes):
            name = f"{uuid.uuid4().hex}.zip"
            with store.open_output_stream(f"{inside}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for path, body in rows:
                    archive.writestr(path.removeprefix("/"), body)
            length = store.get_file_info(f"{inside}/{name}").size
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "length": [length]})

    # Written: a task that is run again makes other archives, and only those of the one that counts are listed.
    return materialize(texts(spark, sf_dir).mapInArrow(write, "path string, length long"), "archives")
