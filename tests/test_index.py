from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from docloom.operators.index import Index, enrich, index_documents, with_defaults
from docloom.operators.parse import with_file_facts


def parsed(spark):
    rows = [("/a.txt", "A", "xx"), ("/b.md", "B", "xx"), ("/b.md", "B2", "xx"), ("/c", "C", "xx")]
    return with_file_facts(spark.createDataFrame(rows, "path string, body string, lang string"))


def sides(spark):
    lang = spark.createDataFrame([("/a.txt", "FR"), ("/b.md", "en"), ("/b.md", "de"), ("/z", "en")], "path string, lang string")
    clusters = spark.createDataFrame([("/a.txt", 4), ("/c", 5), ("/b.md", 6)], "path string, cluster long")
    return lang, clusters


def test_defaults(spark):
    rows = index_documents(parsed(spark)).collect()
    assert {(r["lang"], r["cluster"], r["text_fr"], r["text_en"]) for r in rows} == {("", -1, None, None)}
    assert len(rows) == 4
    kept = with_defaults(parsed(spark), use_parsed_lang=True)
    assert {r["lang"] for r in kept.collect()} == {"xx"}


def test_inner_joins_drop_and_multiply(spark):
    lang, clusters = sides(spark)
    rows = index_documents(parsed(spark), lang, clusters).collect()
    assert Counter((r["path"], r["text"], r["lang"], r["cluster"]) for r in rows) == {
        ("/a.txt", "A", "FR", 4): 1,
        ("/b.md", "B", "en", 6): 1,
        ("/b.md", "B", "de", 6): 1,
        ("/b.md", "B2", "en", 6): 1,
        ("/b.md", "B2", "de", 6): 1,
    }
    first = next(r for r in rows if r["path"] == "/a.txt")
    assert first["id"] == hashlib.sha256(b"/a.txt").hexdigest()
    assert (first["fileName"], first["extension"], first["text_fr"], first["text_en"]) == ("a.txt", "txt", "A", None)
    assert {r["text_en"] for r in rows if r["lang"] == "en"} == {"B", "B2"}
    assert dict(index_documents(parsed(spark), lang, clusters).dtypes)["cluster"] == "int"


def test_left_joins_keep_all(spark):
    lang, clusters = sides(spark)
    docs = with_defaults(parsed(spark))
    rows = Counter((r["path"], r["lang"], r["cluster"]) for r in enrich(docs, lang, clusters, "left").collect())
    assert rows == {("/a.txt", "FR", 4): 1, ("/b.md", "en", 6): 2, ("/b.md", "de", 6): 2, ("/c", "", 5): 1}
    only = Counter((r["path"], r["cluster"]) for r in enrich(docs, clusters=clusters.filter(F.col("cluster") == 5), how="left").collect())
    assert only == {("/a.txt", -1): 1, ("/b.md", -1): 2, ("/c", 5): 1}


def test_texts_move_once(spark, tmp_path):
    """With tables too large to broadcast, the wide side is in one join and one shuffle."""
    lang, clusters = sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = enrich(with_defaults(parsed(spark)), lang, clusters)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in tree.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 3 and tree.count("SortMergeJoin") == 2


def test_a_word_is_in_few_files(spark, tmp_path):
    rows = [(f"/d{i}.txt", " ".join(f"w{(i * 7 + j) % 600}" for j in range(40)) + " common", "en") for i in range(400)]
    docs = with_file_facts(spark.createDataFrame(rows, "path string, body string, lang string").repartition(4))
    built = Index.build(index_documents(docs), str(tmp_path / "index"), buckets=2, shard_chars=1)
    files = built.postings.where("field = 'text'").select("term", F.input_file_name().alias("file")).distinct()
    counts = sorted(r["count"] for r in files.groupBy("term").count().collect())
    assert counts[len(counts) // 2] == 1 and counts[-1] <= 4
    assert built.postings.where("term = 'common'").count() == 400


def test_an_update_reaches_search(spark, tmp_path):
    from docloom.operators import search

    def rows(*pairs):
        return index_documents(with_file_facts(spark.createDataFrame([(p, b, "en") for p, b in pairs], "path string, body string, lang string")))

    def found(index, text):
        paths = {hashlib.sha256(p.encode()).hexdigest(): p for p in ("/a", "/b", "/c", "/d")}
        return {paths[r["id"]]: r["score"] for r in search.hits(index, text).collect()}

    built = Index.build(rows(("/a", "alpha beta"), ("/b", "beta beta x"), ("/c", "alpha")), str(tmp_path / "i"), buckets=2, shard_chars=1)
    after = built.update(rows(("/a", "gamma"), ("/d", "gamma delta"))).update(rows(("/d", "delta"), ("/c", "alpha alpha")))
    assert set(found(after, "alpha")) == {"/c"} and set(found(after, "gamma")) == {"/a"} and set(found(after, "delta")) == {"/d"}
    fresh = after.compact(str(tmp_path / "j"))
    final = Index.build(rows(("/a", "gamma"), ("/b", "beta beta x"), ("/c", "alpha alpha"), ("/d", "delta")), str(tmp_path / "k"), buckets=2, shard_chars=1)
    for text in ("alpha", "beta gamma", "x delta"):
        assert found(after, text) == found(fresh, text) == found(final, text) == found(Index.open(spark, str(tmp_path / "i"), 2, 1), text)
    terms = lambda i: {(r["field"], r["term"], r["df"]) for r in i.terms.collect()}
    assert terms(after) == terms(final) and after.documents.count() == 4
    assert sorted(map(tuple, after.stats.collect())) == sorted(map(tuple, final.stats.collect()))


def test_blocks_hold_what_a_loop_finds(spark):
    """Every place of every word, in blocks of bounded size and in numbers instead of ids."""
    from docloom.operators import index as I

    texts = {i: " ".join(["all", "all", f"w{i % 3}", f"only{i}"][: i % 5]) for i in range(100)}
    docs = spark.createDataFrame([(i, t, f"/p{i % 2}") for i, t in texts.items()], "num long, text string, path string").coalesce(2)
    made = I.blocks(docs, 4)
    assert made.agg(F.max("n")).first()[0] == I.BLOCK
    got = Counter((r["field"], r["term"], r["doc"], r["tf"], r["dl"], tuple(r["positions"])) for r in I.entries(made).collect())
    expected = Counter()
    for i, t in texts.items():
        for field, words in (("text", t.split()), ("path", [f"p{i % 2}"])):
            for w in set(words):
                at = tuple(p for p, x in enumerate(words) if x == w)
                expected[field, w, i, len(at), len(words), at] += 1
    assert got == expected


def test_postings_are_stored_without_ids(spark, tmp_path):
    """32 bytes a posting were most of what was shuffled and written; unique rows are not shuffled to find repeated ids."""
    rows = [(f"/d{i}.txt", " ".join(f"w{(i * 7 + j) % 600}" for j in range(40)), "en") for i in range(50)]
    docs = with_file_facts(spark.createDataFrame(rows, "path string, body string, lang string"))
    built = Index.build(index_documents(docs), str(tmp_path / "index"), buckets=2, shard_chars=1)
    assert dict(built.postings.dtypes)["doc"] == "bigint"
    assert built.postings.join(built.documents, F.col("doc") == F.col("num")).where("field = 'text'").count() == 50 * 40
    assert built.documents.select("num").distinct().count() == 50


def test_a_block_is_one_array(spark):
    """Of a word in one document, five arrays were most of what was shuffled; values of more than two bytes have a wider one."""
    from docloom.operators import index as I

    far = " ".join(["x"] * 40_000) + " end"
    rows = [(1, "a b a", "/p"), (2, far, "/q"), (5 + (1 << 40), "a", None), (7, None, "/r"), (I.NO_NUMBER, "a", "/s")]
    made = I.blocks(spark.createDataFrame(rows, "num long, text string, path string").coalesce(1), 4)
    assert made.columns == ["bucket", "field", "term", "n", "first", "packed", "wide"]
    held = {(r["term"], r["first"]): (r["packed"], r["wide"]) for r in made.where("field = 'text'").collect()}
    assert held["b", 1] == ([0, 1, 3, 0, 1], None)
    assert held["end", 2] == (None, [0, 1, 40_001, 0, 40_000])
    got = {(r["term"], r["doc"], r["tf"], r["dl"], tuple(r["positions"])) for r in I.entries(made).where("field = 'text'").collect()}
    assert got == {("a", 1, 2, 3, (0, 2)), ("b", 1, 1, 3, (1,)), ("x", 2, 40_000, 40_001, tuple(range(40_000))), ("end", 2, 1, 40_001, (40_000,)),
                   ("a", 5 + (1 << 40), 1, 1, (0,)), ("a", I.NO_NUMBER, 1, 1, (0,))}


def test_words_are_grouped_over_batches(spark):
    """A batch has few rows beside a group: grouped one by one, words came in more blocks."""
    from docloom.operators import index as I

    docs = spark.range(90).selectExpr("id AS num", "concat('all w', id) AS text", "null AS path").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        blocks = I.blocks(docs, 4).where("term = 'all'").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r["n"] for r in blocks) == [90 - 2 * I.BLOCK, I.BLOCK, I.BLOCK]


def test_texts_are_stored_once(spark, tmp_path):
    """The language fields are made as documents are read; in one version and in several."""
    rows = lambda *given: index_documents(with_file_facts(spark.createDataFrame(list(given), "path string, body string, lang string")), use_parsed_lang=True)
    first = rows(("/a", "un deux", "FR"), ("/b", "one two", "en"), ("/c", "eins", "de"))
    built = Index.build(first, str(tmp_path / "i"), buckets=2, shard_chars=1)
    [folder] = tmp_path.glob("i/*/documents")
    assert not {"text_fr", "text_en"} & set(spark.read.parquet(str(folder)).columns)
    assert built.documents.columns == [*first.columns, "num", "shard"]
    updated = built.update(rows(("/a", "three", "en"), ("/d", "quatre", "fr")))
    fields = lambda d: {(r["path"], r["text_fr"], r["text_en"]) for r in d.collect()}
    assert fields(built.documents) == fields(first)
    assert fields(updated.documents) == {("/a", None, "three"), ("/b", None, "one two"), ("/c", None, None), ("/d", "quatre", None)}
    plain = Index.build(first.drop("text_fr", "text_en"), str(tmp_path / "j"), buckets=2, shard_chars=1)
    assert "text_fr" not in plain.documents.columns


def test_what_a_batch_replaces_is_counted_without_its_texts(spark, tmp_path, plan, monkeypatch):
    from docloom.operators import index as I

    rows = lambda n, text: index_documents(with_file_facts(spark.createDataFrame([(f"/{i}", text, "en") for i in range(n)], "path string, body string, lang string")))
    built = Index.build(rows(40, "old words words"), str(tmp_path / "i"), buckets=2, shard_chars=1)
    seen = []
    monkeypatch.setattr(I, "_gone", lambda *given, own=I._gone: seen.append(own(*given)) or seen[-1])
    after = built.update(rows(15, "new")).update(rows(5, "newer words"))
    counts = {(r["term"], r["df"]) for r in after.terms.where("field = 'text'").collect()}
    assert counts == {("old", 25), ("words", 30), ("new", 10), ("newer", 5)}
    assert {(r["total_len"], r["n_docs"]) for r in after.stats.where("field = 'text'").collect()} == {(25 * 3 + 10 + 5 * 2, 40)}
    assert len(seen) == 2 and not any("text#" in plan(gone) for gone in seen)
