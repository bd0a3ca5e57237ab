"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, chat, collocations, lines, merkle, minhash, neighbours, packing, quality, sharding, site_style, token_counts, vector_dedup
from docloom.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, BYTE_BPE, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=16, law="rows")
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, added_tokens=True)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.LineDedup(table(spark, sf_dir, "documents")).counted()
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_text(table(spark, sf_dir, "pages"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 20 == 0, neighbours.fit(vectors), k=20)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_breaks = F.replace(F.col("f4"), F.lit("\n"), F.lit(""))
    tampered = F.crc32(F.encode(F.col("id").cast("string"), "UTF-8")) % 2 == 0
    return merkle.audit(table(spark, sf_dir, "documents"), without_breaks, tampered)


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_token_counts, op3_minhash, op4_sharding, op5_chat, op6_packing, op7_line_dedup, op8_site_style,
        op9_neighbours, op10_quality, op11_collocations, op12_merkle,
        op13_vector_dedup,
    )
}
