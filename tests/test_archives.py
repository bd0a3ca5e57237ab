from __future__ import annotations

import io
import struct
import zipfile

import pytest

from docloom.sources import archives as A
from docloom.sources import files as S


def packed(entries: dict[str, bytes], method=zipfile.ZIP_DEFLATED, stream: bool = False) -> bytes:
    out = io.BytesIO()
    target = Unseekable(out) if stream else out
    with zipfile.ZipFile(target, "w", method) as archive:
        for name, body in entries.items():
            archive.writestr(name, body)
    return out.getvalue()


class Unseekable(io.RawIOBase):
    """So that sizes follow the entries."""

    def __init__(self, out):
        self.out = out

    def writable(self):
        return True

    def write(self, data):
        return self.out.write(data)


def noise(n: int, seed: int) -> bytes:
    import random

    return random.Random(seed).randbytes(n)


def rows(df, root) -> dict:
    found = {r["path"].split(f"{root}/")[1]: (None if r["body"] is None else bytes(r["body"]), r["status"]) for r in df.collect()}
    assert len(found) == df.count()
    return found


def expected(name: str, entries: dict[str, bytes]) -> dict:
    return {f"{name}/{k}": (v, "ok") for k, v in entries.items() if not k.endswith("/")}


@pytest.fixture
def many():
    return {f"d{i % 7}/é{i}.txt": noise(3000 + i * 37, i) for i in range(60)} | {"empty.txt": b"", "dir/": b""}


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
@pytest.mark.parametrize("stream", [False, True])
def test_one_archive_is_read_by_several_tasks(spark, tmp_path, many, method, stream):
    (tmp_path / "big.zip").write_bytes(packed(many, method, stream))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "SMALL.Zip").write_bytes(packed({"a.txt": b"alpha"}))
    found = A.scan_archives(spark, str(tmp_path), range_bytes=20_000)
    assert rows(found, tmp_path) == expected("big.zip", many) | expected("sub/SMALL.Zip", {"a.txt": b"alpha"})
    parts = A.planned(A.archives(spark, str(tmp_path)), 20_000).where("path like '%big.zip'").select("part").distinct().count()
    assert parts > 5 and found.rdd.getNumPartitions() > 5


def test_listing_opens_no_archive(spark, tmp_path, plan):
    (tmp_path / "a.zip").write_bytes(packed({"a.txt": b"a"}))
    assert "content" not in plan(A.archives(spark, str(tmp_path))).split("ReadSchema")[1].splitlines()[0]


def test_archives_within_archives_and_within_themselves(spark, tmp_path):
    inner = packed({"t.txt": b"t", "deep.ZIP": packed({"u.txt": b"u"})})
    (tmp_path / "o.zip").write_bytes(packed({"n.zip": inner, "x.txt": b"x"}))
    assert rows(A.scan_archives(spark, str(tmp_path)), tmp_path) == {
        "o.zip/n.zip/t.txt": (b"t", "ok"), "o.zip/n.zip/deep.ZIP/u.txt": (b"u", "ok"), "o.zip/x.txt": (b"x", "ok"),
    }


def test_an_archive_met_again_within_itself_ends(monkeypatch):
    monkeypatch.setattr(S, "_opened", lambda path, body: iter([(f"{path}/r.zip", body, "ok"), (f"{path}/t.txt", b"t", "ok")]))
    assert list(S._entries("/r.zip", b"same")) == [("/r.zip/r.zip", None, "corrupt"), ("/r.zip/t.txt", b"t", "ok")]


def test_damage(spark, tmp_path, many):
    body = bytearray(packed(many))
    (tmp_path / "cut.zip").write_bytes(body[: body.rindex(b"PK\x05\x06") - 500])
    broken = bytearray(packed({"a.txt": b"a" * 50, "b.txt": noise(4000, 1), "c.txt": b"c"}))
    broken[broken.index(b"b.txt") + 300] ^= 0xFF
    (tmp_path / "broken.zip").write_bytes(broken)
    (tmp_path / "tiny.zip").write_bytes(b"P")
    (tmp_path / "junk.zip").write_bytes(noise(3 * A._CHUNK, 5))
    found = rows(A.scan_archives(spark, str(tmp_path), range_bytes=20_000), tmp_path)
    assert found == expected("cut.zip", many) | {
        "cut.zip": (None, "corrupt"), "tiny.zip": (None, "corrupt"), "junk.zip": (None, "corrupt"),
        "broken.zip/a.txt": (b"a" * 50, "ok"), "broken.zip/b.txt": (None, "corrupt"), "broken.zip/c.txt": (b"c", "ok"),
    }


def test_zip64(spark, tmp_path):
    entries = {"a.txt": b"alpha", "b.txt": noise(5000, 2)}
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in entries.items():
            with archive.open(name, "w", force_zip64=True) as out:
                out.write(body)
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as archive:  # more entries than the short directory counts
        for i in range(66_000):
            archive.writestr(f"{i}", b"")
    found = A.scan_archives(spark, str(tmp_path))
    assert rows(found.where("path like '%z.zip%'"), tmp_path) == expected("z.zip", entries)
    assert found.where("path like '%many.zip/%' and status = 'ok'").count() == 66_000


def test_an_entry_that_no_value_can_hold(spark, tmp_path, monkeypatch):
    body = bytearray(packed({"a.txt": b"alpha", "b.txt": b"b"}))
    at = body.rindex(b"PK\x01\x02", 0, body.rindex(b"PK\x01\x02"))
    body[at + 24 : at + 28] = struct.pack("<I", 2**32 - 2)
    (tmp_path / "l.zip").write_bytes(body)
    assert rows(A.scan_archives(spark, str(tmp_path)), tmp_path) == {
        "l.zip/a.txt": (None, f"too_large:{2**32 - 2}"), "l.zip/b.txt": (b"b", "ok"),
    }


def test_no_archives(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a")
    assert A.scan_archives(spark, str(tmp_path)).count() == 0


def test_places_of_files():
    for path in ("/a/b.zip", "file:/a/b.zip", "file:///a/b.zip"):
        assert A.store_of(path)[1] == "/a/b.zip"


def test_recovery_takes_time_in_proportion():
    import time

    def took(n: int) -> float:
        whole = packed({f"{i}.txt": noise(3000, i) for i in range(n)}, stream=True)
        begin = time.process_time()
        assert sum(r[2] == "ok" for r in S._streamed("/x.zip", whole[: whole.index(b"PK\x01\x02")])) == n
        return time.process_time() - begin

    assert took(8000) < 12 * max(took(1000), 0.02)
