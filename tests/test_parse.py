from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from docloom.functions import paths, sql
from docloom.operators import parse

RAW = "path string, body binary"


def test_file_facts(spark):
    cases = {
        "C:\\a\\b.tar.GZ": ("b.tar.GZ", "GZ"),
        "/x/y": ("y", ""),
        "/x/.hid": (".hid", "hid"),
        "z.zip/in/a.Pdf": ("a.Pdf", "Pdf"),
        "/d.e/f": ("f", ""),
        "/d/": ("", ""),
        "/d/x.": ("x.", ""),
    }
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    found = {r["path"]: (r["fileName"], r["extension"]) for r in parse.with_file_facts(df).collect()}
    assert found == cases


def test_sql_functions_agree_with_the_column_functions(spark):
    sql.register_sql_functions(spark)
    df = spark.createDataFrame([("C:\\a_b\\c.d.TXT", "it's 3.14 a.b x"), ("/u/v", "")], "path string, body string")
    df.createOrReplaceTempView("some_docs")
    named = spark.sql(
        "SELECT extract_file_name(path), extract_extension(path), document_id(path), path_to_words(path), "
        "text_words(body), date_to_text(NULL), date_to_text(TIMESTAMP '2020-02-03 04:05:06') FROM some_docs"
    )
    from docloom.functions.text import words

    p = F.col("path")
    direct = df.select(
        paths.file_name(p), paths.file_extension(p), paths.doc_id(p), paths.path_words(p), words(F.col("body")),
        F.lit(""), F.lit("2020-02-03"),
    )
    assert sorted(map(tuple, named.collect())) == sorted(map(tuple, direct.collect()))


PAGE = """<!DOCTYPE html><HTML><head><title>A &amp;
 B</title><meta name="author" content="Zo&eacute;"><META NAME="keywords" CONTENT="x, y">
<style>p{}</style><script>var t="</p>";</script></HEAD><body><!-- not <b>this</b> --><p>One<br>two &lt;3</p>
<script>no()</script></body></HTML>"""


def test_html(spark):
    raw = spark.createDataFrame(
        [("/a.HTML", PAGE.encode()), ("/b.htm", b"<p>plain</p>"), ("/c.html", b"")], RAW
    )
    found = {r["path"]: (r["body"], r["status"]) for r in parse.extract_text(raw).collect()}
    assert found["/a.HTML"] == ("One two <3\nA & B\nZoé\nx, y", "ok")
    assert found["/b.htm"] == ("plain", "ok")
    assert found["/c.html"] == ("", "ok")


def test_broken_pages_are_read_in_one_go(spark):
    pages = {
        "/lt.html": ("<" * 300_000, "<" * 300_000),
        "/open.html": ("a<script>" * 50_000, "a"),
        "/comment.html": ("a<!--" * 50_000, "a"),
        "/less.html": ("<p>3 < 5 and 7 > 2</p>", "3 < 5 and 7 > 2"),
        "/header.html": ("<header>x</header><titles>y", "x y"),
        "/metas.html": ('<meta name="author" content="' * 20_000, '<meta name="author" content="' * 20_000),
    }
    raw = spark.createDataFrame([(p, h.encode()) for p, (h, _) in pages.items()], RAW)
    found = {r["path"]: r["body"] for r in parse.extract_text(raw).collect()}
    assert {p: found[p] == text for p, (_, text) in pages.items()} == dict.fromkeys(pages, True)


def test_missing_metadata_is_null_not_text(spark):
    df = spark.createDataFrame([(PAGE,), ("<p>x</p>",)], "html string")
    first, second = parse.html_metadata(df).select("title", *parse.META_NAMES).collect()
    assert tuple(first) == ("A & B", "Zoé", None, "x, y", None)
    assert tuple(second) == (None,) * 5


def test_text_is_decoded_and_no_file_is_lost(spark):
    raw = spark.createDataFrame(
        [("/a.TXT", "é".encode()), ("/b", b"ok \xff"), ("/c.txt", None), ("/d.bin", b"x")], RAW
    )
    found = {r["path"]: (r["body"], r["status"]) for r in parse.extract_text(raw).collect()}
    assert found == {
        "/a.TXT": ("é", "ok"),
        "/b": ("ok \ufffd", "ok"),
        "/c.txt": ("", "empty"),
        "/d.bin": ("", "unsupported"),
    }


def handlers():
    def loud(path, body):
        return body.decode().upper()

    return {"pdf": loud}


def test_handlers(spark):
    raw = spark.createDataFrame(
        [("/a.PDF", b"x"), ("/b.pdf", b"\xff"), ("/c.doc", b"x"), ("/d.txt", b"x"), ("/e.pdf", None)], RAW
    )
    parsed = parse.extract_text(raw, handlers)
    found = {r["path"]: (r["body"], r["status"]) for r in parsed.collect()}
    assert found == {
        "/a.PDF": ("X", "ok"),
        "/b.pdf": ("", "error"),
        "/c.doc": ("", "unsupported"),
        "/d.txt": ("x", "ok"),
        "/e.pdf": ("", "empty"),
    }
    stats = {r["status"]: r["files"] for r in parse.parse_stats(parsed).collect()}
    assert stats == {"ok": 2, "error": 1, "unsupported": 1, "empty": 1}


def test_every_step_reads_the_files_once(spark, tmp_path, plan):
    spark.createDataFrame([("/a.pdf", b"x")], RAW).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    text = plan(parse.extract_text(raw, handlers))
    assert text.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "Exchange" not in text


def test_a_handler_runs_once_per_file(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def counting():
        def read(path, body):
            with open(calls, "a") as out:
                out.write("x")
            return body.decode()

        return {"pdf": read}

    raw = spark.createDataFrame([(f"/{i}.pdf", b"text") for i in range(5)], RAW)

    def language(body):
        return F.pandas_udf(lambda s: s.str[:2], "string")(body)

    parsed = parse.parse_documents(raw, language, counting)
    assert parsed.columns == ["path", "body", "fileName", "extension", "lang"]
    assert {r["lang"] for r in parsed.collect()} == {"te"}
    assert open(calls).read() == "x" * 5


def test_rescue_picks_encrypted_pdfs_and_keeps_what_was_read(spark):
    raw = spark.createDataFrame(
        [
            ("/a.pdf", b"%PDF-1.4 /Encrypt yes"),
            ("/b.pdf", b"%PDF-1.4 plain"),
            ("/c.txt", b"%PDF-1.4 /Encrypt"),
            ("/d.PDF", b"%PDF-1.4 /Encrypt \xff"),
            ("/e.pdf", b"%PDF-1.4 /Encrypt none"),
        ],
        RAW,
    )

    def reader():
        return lambda path, body: None if b"none" in body else body.decode()[-3:]

    assert [tuple(r) for r in parse.rescue(raw, reader).collect()] == [("/a.pdf", "yes")]


def test_progress_counters(spark):
    raw = spark.createDataFrame([("/a.txt", b"x"), ("/b.bin", b"x")], RAW)
    parsed, watch = parse.observed(parse.extract_text(raw))
    parsed.collect()
    assert watch.get == {"parsed": 2, "error": 0, "unsupported": 1}


def test_dates(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 23, 59), None)], "a timestamp, b timestamp")
    row = df.select(
        paths.date_text(F.col("a")), paths.date_text(F.col("b")), parse.with_dates(F.lit("t"), F.col("a"), F.col("b"))
    ).first()
    assert tuple(row) == ("2024-01-05", "", "t\n2024-01-05")


def test_result_link(spark):
    df = spark.createDataFrame([("C:\\a\\b",)], "path string")
    assert df.select(paths.result_link(F.col("path"))).first()[0] == "file://C:/a/b"
