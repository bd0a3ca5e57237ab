from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import charset as C
from docloom.operators import parse

FRENCH = "Le café était fermé, l'élève rêvait déjà d'un été à Orléans."
RUSSIAN = "Съешь же ещё этих мягких французских булок, да выпей чаю."
GREEK = "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία"

CASES = [
    (b"", "utf-8", ""),
    (b"plain", "utf-8", "plain"),
    (b"\xef\xbb\xbfmark", "utf-8", "mark"),
    (FRENCH.encode(), "utf-8", FRENCH),
    (FRENCH.encode("cp1252"), "windows-1252", FRENCH),
    ("“Œuvre” – 5 €".encode("cp1252"), "windows-1252", "“Œuvre” – 5 €"),
    (RUSSIAN.encode("cp1251"), "windows-1251", RUSSIAN),
    (RUSSIAN.encode("koi8-r"), "koi8-r", RUSSIAN),
    (RUSSIAN.encode("cp866"), "cp866", RUSSIAN),
    (GREEK.encode("cp1253"), "windows-1253", GREEK),
    (b"\xff\xfe" + RUSSIAN.encode("utf-16-le"), "utf-16le", RUSSIAN),
    (b"\xfe\xff" + RUSSIAN.encode("utf-16-be"), "utf-16be", RUSSIAN),
    (FRENCH.encode("utf-16-le"), "utf-16le", FRENCH),
    (FRENCH.encode("utf-16-be"), "utf-16be", FRENCH),
    ("a word 😀 b".encode("utf-16-le"), "utf-16le", "a word 😀 b"),
    (b"\xff\xfe" + b"a\0\x3d\xd8b\0\0\xdc\0\xdcc\0", "utf-16le", "a�b��c"),
    (b"\xfe\xff" + b"\0a\xd8\x3d\0b\xdc", "utf-16be", "a�b�"),
    (b"<meta charset=KOI8-R>" + RUSSIAN.encode("koi8-r"), "koi8-r", "<meta charset=KOI8-R>" + RUSSIAN),
    (b"<p>\xe9<meta content='text/html; charset=iso-8859-2'>\xb1", "iso-8859-2", "<p>é<meta content='text/html; charset=iso-8859-2'>ą"),
    (b"<?xml version='1.0' encoding='iso-8859-15'?><a>\xa4</a>", "iso-8859-15", "<?xml version='1.0' encoding='iso-8859-15'?><a>€</a>"),
    (b"<meta charset=utf-16>\xc3\xa9", "utf-8", "<meta charset=utf-16>é"),
    (b"<meta charset=utf-8>\xe9", "utf-8", "<meta charset=utf-8>�"),
    (b"<meta charset=unknown>\xc3\xa9", "utf-8", "<meta charset=unknown>é"),
    (FRENCH.encode("cp1252") * 5_000, "windows-1252", FRENCH * 5_000),
    (b"\xff\xfe" + ("x😀" * 200_000).encode("utf-16-le"), "utf-16le", "x😀" * 200_000),
    (b"\xfe\xff" + b"\xd8\0" * 100_000, "utf-16be", "�" * 100_000),
]


def test_charsets(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)] + [(-1, None)], "i int, body binary")
    found = df.withColumn("name", C.charset(F.col("body"))).withColumn("text", C.decoded(F.col("body"), F.col("name")))
    rows = {r["i"]: (r["name"], r["text"]) for r in found.collect()}
    assert rows.pop(-1) == (None, None)
    for i, (_, name, text) in enumerate(CASES):
        assert rows[i] == (name, text), i


@pytest.mark.parametrize("name", C.SINGLE_BYTE)
def test_every_byte_of_a_declared_charset(spark, name):
    body = bytes(range(32, 256))
    df = spark.createDataFrame([(body,)], "body binary")
    text = df.select(C.decoded(F.col("body"), F.lit(name)).alias("t")).first()["t"]
    assert text == "".join(bytes([b]).decode(name, errors="ignore") or chr(b) for b in body)
    declared = b"<html><meta charset='" + name.upper().encode() + b"'>"
    assert spark.createDataFrame([(declared,)], "body binary").select(C.charset(F.col("body"))).first()[0] == name


def test_types_by_content(spark):
    cases = {
        b"%PDF-1.4 x": "pdf",
        b"PK\x03\x04x": "zip",
        b"\x89PNG\r\n\x1a\nx": "png",
        b"  <!DOCTYPE html><p>x": "html",
        b"\xef\xbb\xbf<!-- a --><HTML lang=fr>": "html",
        "<html>é".encode("utf-16-le"): "html",
        b"<?xml version='1.0'?><html xmlns='x'>": "html",
        b"<?xml version='1.0'?><feed>": "xml",
        b"<htmlx>": "txt",
        b"a <html>": "txt",
        b"\x01\x02\0\0\0\x07\x08": "bin",
        b"": "txt",
        b"<!--" * 50_000: "txt",
    }
    df = spark.createDataFrame([(b,) for b in cases], "body binary")
    text = C.decoded(F.col("body"), C.charset(F.col("body")))
    assert {bytes(r[0]): r[1] for r in df.select("body", C.content_type(F.col("body"), text)).collect()} == cases


def test_readers_follow_content_where_the_name_tells_nothing(spark):
    raw = [
        ("/a", "<html><title>T</title><meta charset=windows-1251><p>Привет".encode("cp1251")),
        ("/b.txt", b"<html><p>x"),
        ("/c", b"%PDF-1.4"),
        ("/d", b"\x01\x02\0\0\0\x07\x08"),
        ("/e", None),
        ("/f.html", "<p>café".encode("cp1252")),
    ]
    df = spark.createDataFrame(raw, "path string, body binary")
    plain = {r["path"]: (r["body"], r["extension"], r["status"]) for r in parse.extract_text(df).collect()}
    assert plain == {
        "/a": ("Привет\nT", "", "ok"),
        "/b.txt": ("<html><p>x", "txt", "ok"),
        "/c": ("", "", "unsupported"),
        "/d": ("", "", "unsupported"),
        "/e": ("", "", "empty"),
        "/f.html": ("café", "html", "ok"),
    }
    handled = parse.extract_text(df, lambda: {"pdf": lambda path, body: "read"}).where("path = '/c'").first()
    assert (handled["body"], handled["status"]) == ("read", "ok")


def _side(body: bytes, first: int) -> int:
    return body[first : len(body) // 2 * 2 : 2].count(0) + (len(body) % 2 == 1 and body[-1] == 0)


def _loop(body: bytes) -> str | None:
    """UTF-16 by its zeros, counted in a loop."""
    first, second, pairs = _side(body, 0), _side(body, 1), len(body) / 2
    if 0 in body and second >= pairs * 0.5 and first < pairs * 0.1:
        return "utf-16le"
    return "utf-16be" if 0 in body and first >= pairs * 0.5 and second < pairs * 0.1 else None


def test_zeros_and_surrogates_against_loops(spark):
    rng = random.Random(8)
    few = [0, 0, 0, 10, 65, 0xD8, 0xDC, 0xDF, 0xFE, 0xFF]
    bodies = [bytes(rng.choices(few, k=rng.randint(0, 9))) for _ in range(1500)]
    bodies += [bytes(b for _ in range(rng.randint(1, 40)) for b in rng.choice([(65, 0), (66, 0), (10, 0), (0, 0), (0, 67)])) + rng.choice([b"", b"\0"]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body binary")
    rows = df.select("i", C._zeros(F.col("body")).alias("z"), *[C.decoded(F.col("body"), F.lit(n)).alias(n[-2:]) for n in ("utf-16le", "utf-16be")]).collect()
    for r in rows:
        body = bodies[r["i"]]
        assert r["z"] == _loop(body), body
        for order, kind in (("little", "le"), ("big", "be")):
            units = [int.from_bytes(body[i : i + 2], order) for i in range(0, len(body) // 2 * 2, 2)]
            text, i = "", 0
            while i < len(units):
                if 0xD800 <= units[i] < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000:
                    text += chr(0x10000 + (units[i] - 0xD800) * 1024 + units[i + 1] - 0xDC00)
                    i += 1
                else:
                    text += "�" if 0xD800 <= units[i] < 0xE000 else chr(units[i])
                i += 1
            assert r[kind] == (text + "�" * (len(body) % 2)).removeprefix("\ufeff"), (body, kind)


def test_a_text_is_searched_once_for_its_declaration(spark, plan):
    df = spark.range(1).select(F.col("id").cast("string").cast("binary").alias("body"))
    assert plan(df.select(C._declared(F.col("body")))).count("bcharset") <= 4  # two searches, shown at most twice


def test_pairs_with_zeros_go_in_runs(spark, plan):
    df = spark.range(1).select(F.col("id").cast("string").cast("binary").alias("body"))
    text = plan(df.select(C.decoded(F.col("body"), C.charset(F.col("body")))))
    assert "(?s)(.)(.)" not in text and "++" in text
