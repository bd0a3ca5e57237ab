"""Charset and type of a file by its bytes, and its text. All are built-in expressions.

The charset is that of a byte-order mark; else the one a page or an XML file declares; else UTF-16 if half of the pairs of
bytes have a zero on one side; else UTF-8 if the bytes are valid UTF-8; else the charset of one byte a character in which
pairs of neighbouring characters look most like words, or UTF-8 if none has such pairs. A file with a zero byte that is not UTF-16 is no text.

Broken sequences become the replacement character; nothing is dropped but a byte-order mark. Charsets of several bytes
other than UTF-8 and UTF-16 are not read: where one is declared the file is judged as if none were. UTF-32 is not told
from UTF-16.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names by which pages declare charsets of one byte a character, after the Encoding Standard.
SINGLE_BYTE = {
    "windows-1250": ["windows-1250", "cp1250", "x-cp1250"],
    "windows-1251": ["windows-1251", "cp1251", "x-cp1251"],
    "windows-1252": ["windows-1252", "cp1252", "x-cp1252", "iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "l1", "ascii", "us-ascii"],
    "windows-1253": ["windows-1253", "cp1253", "x-cp1253"],
    "windows-1254": ["windows-1254", "cp1254", "x-cp1254", "iso-8859-9", "latin5", "l5"],
    "iso-8859-2": ["iso-8859-2", "iso8859-2", "latin2", "l2"],
    "iso-8859-5": ["iso-8859-5", "iso8859-5", "cyrillic"],
    "iso-8859-7": ["iso-8859-7", "iso8859-7", "greek"],
    "iso-8859-15": ["iso-8859-15", "iso8859-15", "latin9", "l9"],
    "koi8-r": ["koi8-r", "koi8", "koi"],
    "cp866": ["ibm866", "cp866", "866"],
}
# A declaration that can be read byte by byte is not in UTF-16, whatever it says.
UTF_8_NAMES = ["utf-8", "utf8", "unicode-1-1-utf-8", "utf-16", "utf-16le", "utf-16be"]

# First bytes of formats, each as characters of one byte.
FIRST_BYTES = {
    "pdf": ["%PDF-"],
    "zip": ["PK\x03\x04", "PK\x05\x06"],
    "doc": ["\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"],
    "rtf": ["{\\rtf"],
    "gz": ["\x1f\x8b"],
    "png": ["\x89PNG\r\n\x1a\n"],
    "jpg": ["\xff\xd8\xff"],
    "gif": ["GIF87a", "GIF89a"],
    "7z": ["7z\xbc\xaf\x27\x1c"],
    "rar": ["Rar!\x1a\x07"],
}

# How well neighbouring characters go together in a script: what words have, and what they do not have.
_LATIN = (r"[A-Za-z][ß-öø-ÿœšž]|[¿¡«“‘][A-Za-zÀ-ÿ]|[A-Za-zÀ-ÿ][»”’]|[À-ÖØ-öø-ÿŒœŠšŽž][a-z]", r"[À-ÖØ-öø-ÿ]{2}|[A-Za-z][\u0080-¿][A-Za-z]")
_CYRILLIC = (r"[А-Яа-яЁё](?=[а-яё])", r"[а-яё][А-ЯЁ]|[A-Za-z][А-яЁё]|[А-яЁё][A-Za-z]|[\u0080-¿─-▟](?=[А-яЁё])")
_GREEK = (r"[Α-Ωα-ώ](?=[α-ώ])", r"[α-ώ][Α-Ω]|[A-Za-z][Α-ώ]|[Α-ώ][A-Za-z]|[\u0080-¿](?=[Α-ώ])")
# The charsets looked for without a declaration; the first wins a tie.
GUESSED = {"windows-1252": _LATIN, "windows-1251": _CYRILLIC, "koi8-r": _CYRILLIC, "cp866": _CYRILLIC, "windows-1253": _GREEK}

_DECLARED = (
    r"(?i)^[\s\x{00}]*<\?xml\b[^<>]*?\bencoding\s*=\s*[\"']?([a-z0-9_:.-]+)"
    r"|<meta\b[^<>]*?\bcharset\s*=\s*[\"']?\s*([a-z0-9_:.-]+)"
)
_PAGE = r"(?is)^(?:\s++|<!--.*?-->|<\?xml\b[^>]*>)*+<(?:!doctype\s+html|html|head|body|title|meta|script|style)\b"
_XML = r"(?is)^\s*+<\?xml\b"


def byte_text(body: Column) -> Column:
    """One character for each byte."""
    return F.decode(body, "ISO-8859-1")


def _single(chars: Column, name: str) -> Column:
    high = [chr(i) for i in range(128, 256)]
    # Bytes without a meaning are kept as control characters, as browsers do.
    meant = [bytes([i]).decode(name, errors="ignore") or chr(i) for i in range(128, 256)]
    changed = [(h, m) for h, m in zip(high, meant) if h != m]
    return F.translate(chars, "".join(h for h, _ in changed), "".join(m for _, m in changed))


# Byte-order marks, and the charsets they stand for.
_MARKS = {"utf-8": b"\xef\xbb\xbf", "utf-16le": b"\xff\xfe", "utf-16be": b"\xfe\xff"}


def _mark(body: Column) -> Column:
    marks = [(F.startswith(body, F.lit(mark)), name) for name, mark in _MARKS.items()]
    return F.coalesce(*[F.when(found, name) for found, name in marks])


def _without_mark(body: Column, name: str) -> Column:
    mark = _MARKS[name]
    return F.when(F.startswith(body, F.lit(mark)), F.substring(body, F.lit(len(mark) + 1), F.octet_length(body))).otherwise(body)


def _declared(body: Column) -> Column:
    chars = byte_text(body)
    names = {alias: name for name, aliases in [*SINGLE_BYTE.items(), ("utf-8", UTF_8_NAMES)] for alias in aliases}
    # Looked up in a map, as the text would be searched again for every branch of a choice.
    known = F.create_map(*[F.lit(x) for item in names.items() for x in item])
    found = F.lower(F.concat(F.regexp_extract(chars, _DECLARED, 1), F.regexp_extract(chars, _DECLARED, 2)))
    # Texts without the begin of a declaration, which are most, are searched for that only.
    possible = F.contains(body, F.lit(b"<")) & F.rlike(chars, F.lit(r"(?i)<(?:meta|\?xml)\b"))
    return F.when(possible, F.try_element_at(known, found))


def _zeros(body: Column) -> Column:
    """UTF-16 by the zeros among the first and among the second bytes of the pairs."""
    chars, size = byte_text(body), F.octet_length(body)
    # A last byte without a partner counts on both sides.
    last = F.when((size % 2 == 1) & F.endswith(body, F.lit(b"\0")), 1).otherwise(0)

    def zeros(other: str, zero: str) -> Column:
        # Runs of pairs with a zero go, one match for a run and those before it.
        left = F.regexp_replace(chars, rf"(?s)\G((?:{other})*+)(?:{zero})++", "$1")
        return (size - F.length(left)) / 2 + last

    first, second, pairs = zeros(r"[^\x00].", r"\x00."), zeros(r".[^\x00]", r".\x00"), size / 2
    zero = F.contains(body, F.lit(b"\0"))
    return F.when(zero & (second >= pairs * 0.5) & (first < pairs * 0.1), "utf-16le").when(
        zero & (first >= pairs * 0.5) & (second < pairs * 0.1), "utf-16be"
    )


def _guessed(chars: Column) -> Column:
    def score(name: str) -> Column:
        good, bad = GUESSED[name]
        text = _single(chars, name)
        return F.regexp_count(text, F.lit(good)) - 2 * F.regexp_count(text, F.lit(bad))

    # Greatest score; of equal ones the first.
    scored = [F.struct(score(name).alias("s"), F.lit(-i).alias("i"), F.lit(name).alias("name")) for i, name in enumerate(GUESSED)]
    best = F.array_max(F.array(*scored))
    return F.when(best["s"] > 0, best["name"]).otherwise("utf-8")


def charset(body: Column) -> Column:
    """The charset of a file by its bytes; null for null."""
    valid = F.when(F.is_valid_utf8(body.cast("string")), "utf-8")
    found = F.coalesce(_mark(body), _zeros(body), _declared(body), valid, _guessed(byte_text(body)))
    return F.when(body.isNotNull(), found)


def _sixteen(body: Column, little: bool) -> Column:
    """UTF-16 with lone surrogates and an odd last byte replaced, as Spark's decoder refuses them."""
    body = _without_mark(body, "utf-16le" if little else "utf-16be")
    chars = byte_text(body)
    any_, high, low, plain = ".", r"[\xD8-\xDB]", r"[\xDC-\xDF]", r"[^\xD8-\xDF]"
    unit, lead, trail, alone = [(any_ + x if little else x + any_) for x in (plain, high, low, r"[\xD8-\xDF]")]
    wrong, name = ("\xfd\xff", "UTF-16LE") if little else ("\xff\xfd", "UTF-16BE")
    even = F.when(F.length(chars) % 2 == 1, F.concat(F.substring(chars, F.lit(1), F.length(chars) - 1), F.lit(wrong))).otherwise(chars)
    whole = F.regexp_replace(even, rf"(?s)\G((?:{unit}|{lead}{trail})*+){alone}", f"$1{wrong}")
    # Most texts have no surrogates at all; one fast search tells.
    clean = (F.octet_length(body) % 2 == 0) & ~F.rlike(chars, F.lit(rf"(?s)\G(?:{unit})*+{alone}"))
    return F.when(clean, F.decode(body, name)).otherwise(F.decode(F.encode(whole, "ISO-8859-1"), name))


def decoded(body: Column, name: Column) -> Column:
    """The text of ``body`` in the charset ``name``, as ``charset`` gives it; without a byte-order mark."""
    chars = byte_text(body)
    text = F.when(name == "utf-8", F.make_valid_utf8(_without_mark(body, "utf-8").cast("string")))
    text = text.when(name == "utf-16le", _sixteen(body, True)).when(name == "utf-16be", _sixteen(body, False))
    return reduce(lambda w, single: w.when(name == single, _single(chars, single)), SINGLE_BYTE, text)


def content_type(body: Column, text: Column) -> Column:
    """What a file is by its first bytes and its text: an extension of ``FIRST_BYTES``, ``html``, ``xml``, ``bin`` or ``txt``."""
    chars = byte_text(F.substring(body, 1, 16))
    known = None
    for kind, starts in FIRST_BYTES.items():
        test = reduce(lambda a, b: a | b, [F.startswith(chars, F.lit(s)) for s in starts])
        known = F.when(test, kind) if known is None else known.when(test, kind)
    return (
        known.when(F.contains(text, F.lit("<")) & F.rlike(text, F.lit(_PAGE)), "html")
        .when(F.contains(text, F.lit("<")) & F.rlike(text, F.lit(_XML)), "xml")
        .when(F.contains(text, F.lit("\0")), "bin")
        .otherwise("txt")
    )
