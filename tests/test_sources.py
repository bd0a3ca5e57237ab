from __future__ import annotations

import io
import zipfile

import pyarrow as pa
import pytest

from docloom.sources.files import drop_blacklisted, expand_archives, hidden_files, scan_expanded, scan_files


def packed(**entries: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in entries.items():
            archive.writestr(name, body)
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.TXT").write_text("alpha")
    (tmp_path / "p").write_text("short name")
    (tmp_path / "sub" / "b.txt").write_text("beta")
    (tmp_path / "sub" / "Thumbs.DB").write_text("no")
    (tmp_path / "_x.txt").write_text("hidden from Spark")
    (tmp_path / ".hid").write_text("hidden from Spark")
    inner = packed(**{"d.txt": b"delta"})
    (tmp_path / "outer.ZIP").write_bytes(
        packed(**{"c.txt": b"gamma", "dir/": b"", "Thumbs.db": b"kept", "deep/inner.zip": inner})
    )
    (tmp_path / "broken.zip").write_bytes(inner[: len(inner) // 2])
    return tmp_path


def rows(df, root):
    return {
        (r["path"].split(f"{root}/")[1], bytes(r["body"]) if r["body"] is not None else None, r["status"])
        for r in df.collect()
    }


EXPANDED = {
    ("a.TXT", b"alpha", "ok"),
    ("p", b"short name", "ok"),
    ("sub/b.txt", b"beta", "ok"),
    ("outer.ZIP/c.txt", b"gamma", "ok"),
    ("outer.ZIP/Thumbs.db", b"kept", "ok"),
    ("outer.ZIP/deep/inner.zip/d.txt", b"delta", "ok"),
    ("broken.zip/d.txt", b"delta", "ok"),  # its directory is cut off
    ("broken.zip", None, "corrupt"),
}


def test_scan_lists_every_visible_file_once(spark, folder):
    found = scan_files(spark, str(folder))
    assert found.columns == ["path", "lang", "body"]
    names = sorted(r["path"].split(f"{folder}/")[1] for r in found.collect())
    assert names == ["a.TXT", "broken.zip", "outer.ZIP", "p", "sub/b.txt"]
    assert {r["lang"] for r in found.collect()} == {""}


def test_archives_are_expanded_in_both_ways(spark, folder):
    assert rows(scan_expanded(spark, str(folder)), folder) == EXPANDED
    assert rows(expand_archives(scan_files(spark, str(folder))), folder) == EXPANDED


def test_entries_can_be_filtered_too(spark, folder):
    kept = rows(scan_expanded(spark, str(folder), filter_entries=True), folder)
    assert kept == {r for r in EXPANDED if "Thumbs" not in r[0]}


def entries(spark, body: bytes) -> set[tuple[str, str]]:
    raw = spark.createDataFrame([("/x.zip", "", bytes(body))], "path string, lang string, body binary")
    return {(r["path"], r["status"]) for r in expand_archives(raw).collect()}


def test_entries_round_a_damaged_one_are_kept(spark):
    body = bytearray(packed(**{"a.txt": b"a" * 100, "b.txt": bytes(range(256)) * 8, "c.txt": b"c"}))
    body[body.index(b"b.txt") + 40] ^= 0xFF
    assert entries(spark, body) == {("/x.zip/a.txt", "ok"), ("/x.zip/b.txt", "corrupt"), ("/x.zip/c.txt", "ok")}


def test_entries_without_a_directory_are_read_from_their_headers(spark):
    whole = packed(**{"a.txt": b"a" * 100, "n.zip": packed(**{"deep.txt": b"d"}), "b.txt": bytes(range(256)) * 8})
    cut = whole[: whole.rindex(b"PK\x01\x02") - 40]
    found = entries(spark, cut[: cut.index(b"PK\x01\x02", cut.index(b"b.txt"))])
    assert found == {("/x.zip/a.txt", "ok"), ("/x.zip/n.zip/deep.txt", "ok"), ("/x.zip/b.txt", "ok"), ("/x.zip", "corrupt")}


def test_archives_are_opened_however_deep(spark):
    body = packed(**{"t.txt": b"t"})
    for _ in range(300):
        body = packed(**{"n.zip": body})
    assert entries(spark, body) == {("/x.zip" + "/n.zip" * 300 + "/t.txt", "ok")}


def test_a_large_entry_gets_a_batch_of_its_own():
    from docloom.sources import files

    rows = [("/a.zip", packed(**{"s.txt": b"s", "l.txt": b"l" * (files._BATCH_BYTES + 1), "t.txt": b"t"}))]
    batch = pa.RecordBatch.from_pylist([{"path": p, "body": b} for p, b in rows])
    assert [b.num_rows for b in files._expand_batches(iter([batch]))] == [1, 1, 1]


def test_hidden_files_are_counted(spark, tmp_path):
    for name in ("a.txt", ".b.txt", "_c.txt", "d/e.txt", ".f/g.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    assert hidden_files(spark, str(tmp_path)) == 3
    assert scan_files(spark, str(tmp_path)).count() == 2


def test_null_body_of_an_archive(spark):
    raw = spark.createDataFrame([("/x.zip", "", None)], "path string, lang string, body binary")
    assert [r["status"] for r in expand_archives(raw).collect()] == ["corrupt"]


def test_blacklist_ignores_case_and_looks_at_whole_names(spark):
    paths = ["/a/.ds_store", "C:\\b\\THUMBS.db", "/a/Thumbs.db.txt", "/Thumbs.db/x"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r["path"] for r in drop_blacklisted(df).collect()} == {"/a/Thumbs.db.txt", "/Thumbs.db/x"}
