from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docloom.operators import index
from docloom.operators.words import tokenize, wordcount
from docloom.sinks.tables import DEFAULT_TARGET_BYTES, pack_files, save_bucketed, save_table, target_bytes
from docloom.sources.tables import read_table, register_tables


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_bad_sizes_fall_back_with_a_warning():
    assert target_bytes(None) == DEFAULT_TARGET_BYTES
    assert target_bytes("1000") == 1000
    for bad in ("many", "-5", "0"):
        with pytest.warns(UserWarning):
            assert target_bytes(bad) == DEFAULT_TARGET_BYTES


def test_files_are_rolled_by_size(spark, tmp_path):
    # Hashes, so that packing cannot make them much smaller; all in one partition.
    hashes = F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.sha2(F.concat("id", i.cast("string")), 256))
    df = (
        spark.range(400)
        .coalesce(1)
        .select(F.col("id").cast("string").alias("id"))
        .select(F.col("id").alias("path"), F.encode(F.array_join(hashes, ""), "UTF-8").alias("body"))
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    pack_files(df, str(tmp_path / "small"), 1_000_000)
    pack_files(df, str(tmp_path / "one"), 1_000_000_000)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    assert len(files(tmp_path / "one")) == 1 < len(files(tmp_path / "small"))
    assert all(".snappy." in f for f in files(tmp_path / "small"))
    assert read_table(spark, str(tmp_path / "small")).select("path").distinct().count() == 400


def test_an_existing_folder_is_refused(spark, tmp_path):
    df = spark.range(3)
    for write in (save_table, pack_files):
        with pytest.raises(AnalysisException):
            write(df, str(tmp_path))


def test_tables_can_be_named_for_sql(spark, tmp_path):
    save_table(spark.createDataFrame([("a", "en")], "path string, lang string"), str(tmp_path / "lang"))
    register_tables(spark, str(tmp_path), ["lang"])
    assert spark.sql("SELECT lang FROM lang").first()[0] == "en"
    spark.catalog.dropTempView("lang")
    register_tables(spark, str(tmp_path), ["lang"], external=True, prefix="stored_")
    assert spark.sql("SELECT path FROM stored_lang").first()[0] == "a"
    with pytest.raises(AnalysisException):
        register_tables(spark, str(tmp_path), ["lang"], external=True, prefix="stored_")
    spark.sql("DROP TABLE stored_lang")
    assert files(tmp_path / "lang")


def test_word_counts_of_a_bucketed_table_need_no_shuffle(spark, tmp_path, plan):
    docs = spark.createDataFrame([(f"/{i}", "a b a") for i in range(20)], "path string, body string")
    table = save_bucketed(docs, "bucketed_docs", str(tmp_path / "b"), 4)
    counts = wordcount(tokenize(table))
    assert "Exchange" not in plan(counts)
    assert counts.count() == 40
    spark.sql("DROP TABLE bucketed_docs")


def index_rows(spark, texts, lang="en"):
    parsed = spark.createDataFrame([(p, t, p, "") for p, t in texts], "path string, body string, fileName string, extension string")
    return index.index_documents(parsed.withColumn("lang", F.lit(lang)), use_parsed_lang=True)


def test_upsert_replaces_rows_with_the_same_id(spark, tmp_path):
    path = str(tmp_path / "index")
    index.write_index(index_rows(spark, [(f"/{i}", "old") for i in range(50)]), path)
    index.upsert_index(index_rows(spark, [("/3", "new"), ("/77", "new"), ("/3", "new")]), path)
    stored = {r["path"]: r["text"] for r in spark.read.parquet(path).collect()}
    assert len(stored) == 51 == spark.read.parquet(path).count()
    assert {p for p, t in stored.items() if t == "new"} == {"/3", "/77"}


def test_an_untouched_shard_is_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "index")
    index.write_index(index_rows(spark, [(f"/{i}", "old") for i in range(50)]), path)
    before = {f: os.path.getmtime(f) for f in files(path)}
    index.upsert_index(index_rows(spark, [("/3", "new")]), path)
    after = {f: os.path.getmtime(f) for f in files(path)}
    assert len(before.items() - after.items()) == 1


def test_the_last_version_wins(spark):
    rows = [("i", 1, "one"), ("i", 3, "three"), ("i", 2, "two"), ("j", 1, "only")]
    df = spark.createDataFrame(rows, "id string, v int, text string")
    assert {(r["id"], r["text"]) for r in index.latest(df, F.col("v")).collect()} == {("i", "three"), ("j", "only")}


def test_rows_are_sent_in_batches(spark, tmp_path):
    folder = str(tmp_path)

    def sender():
        def send(batch):
            with open(f"{folder}/{batch[0]['id']}", "w") as out:
                out.write(str(len(batch)))

        return send

    index.push_documents(spark.range(250).coalesce(1), sender)
    assert {f: open(f"{folder}/{f}").read() for f in os.listdir(folder)} == {"0": "100", "100": "100", "200": "50"}
