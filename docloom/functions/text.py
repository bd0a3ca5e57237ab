"""Column functions over text: words, shingles, letter trigrams and HTML."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_CHAR = r"[\p{L}\p{M}\p{N}_]"

# Word breaking after Unicode Standard Annex 29. Letters may be joined by one of . : · ' ’ ‘
# and digits by one of . , ; ' ’ ‘. A word has a letter or a digit in it. All repeats are
# possessive: the matcher then loops instead of recursing, so that a chain such as
# 1.2.3.4..., however long, cannot overflow the stack, and it never tries a text twice.
_FIRST = r"[\p{L}\p{Nd}]"
_INSIDE = r"[\p{L}\p{M}\p{Nd}_]"
_JOINER = r"(?:(?<=[\p{L}\p{M}])[.:·'’‘](?=\p{L})|(?<=\p{Nd})[.,;'’‘](?=\p{Nd}))"
_RUN = rf"{_FIRST}{_INSIDE}*+(?:{_JOINER}{_INSIDE}++)*+"
WORD = rf"{_RUN}|(?<!_)_++{_RUN}"

# Han and Hiragana characters are words by themselves. Texts without any character from
# that part of Unicode on, which is quick to see, need not look for them.
_FAR = r"[^\x{0}-\x{2FFF}]"
_SINGLE = r"[々〇〡-〩〸-〻ぁ-ゟ㐀-䶿一-鿿豈-﫿\x{20000}-\x{323AF}]"

# Attributes of a tag. A quoted value may hold a closing bracket, but no opening one: so a
# quote that is never closed is given up at the next tag, and no text is scanned twice.
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+"""

# What carries no markup and no text: scripts, styles, comments. They run to their own end mark,
# and to the end of the page if that is missing.
_HIDDEN = (
    rf"(?is)<script\b{_ATTRIBUTES}>.*?(?:</script\s*>|\z)"
    rf"|<style\b{_ATTRIBUTES}>.*?(?:</style\s*>|\z)"
    r"|<!--.*?(?:-->|\z)"
)
# What is taken out of a page, in one pass. The last alternative is a tag with a stray quote.
HTML_DROP = (
    rf"{_HIDDEN}|<title\b{_ATTRIBUTES}>[^<]*(?:</title\s*>)?"
    rf"|</?[a-z!?]{_ATTRIBUTES}>|</?[a-z!?][^<>]*>"
)

# A reference to a character after its "&": by number, by number in hex, or by name.
_REFERENCE = r"^(#[0-9]{1,8}|#[xX][0-9A-Fa-f]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
# The names of HTML 4 from the standard library; a blank that does not break is a blank here.
_NAMED = {name: chr(code) for name, code in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}

BLANKS = r"[ \t\n\f\r]+"


def words(text: Column) -> Column:
    """All words of ``text`` in order, case kept; an empty array for null."""
    return _cut(_apart(text))


def terms(text: Column) -> Column:
    """The words of ``text`` in lower case, as the search index keeps them."""
    return _cut(F.lower(_apart(text)))


def _cut(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _apart(text: Column) -> Column:
    """Blanks round the characters that are words by themselves."""
    return F.when(F.rlike(text, F.lit(_FAR)), F.regexp_replace(text, _SINGLE, " $0 ")).otherwise(text)


def words_sql(text: str) -> str:
    """``words`` of a column as SQL text."""
    far, single, word = (p.replace("\\", "\\\\").replace("'", "\\'") for p in (_FAR, _SINGLE, WORD))
    apart = f"CASE WHEN rlike({text}, '{far}') THEN regexp_replace({text}, '{single}', ' $0 ') ELSE {text} END"
    return f"coalesce(regexp_extract_all({apart}, '{word}', 0), cast(array() as array<string>))"


def each(df: DataFrame, array: str | Column, *keep: str | Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element of ``array``, next to the ``keep`` columns.

    For arrays that are costly to make. A plain explode lets the optimiser derive the test
    "array not empty" and push it to the scan, where the text would be cut up a second
    time. The outer form does not, and its null rows are dropped afterwards.
    """
    if position is None:
        rows = df.select(*keep, F.explode_outer(array).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(array).alias(position, name))
    return rows.filter(F.col(name).isNotNull())


def shingles(tokens: Column, n: int) -> Column:
    """Every run of ``n`` neighbouring words, joined by one blank."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))


def letter_words(text: Column) -> Column:
    """Runs of letters in lower case, the unit of the language profiles."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def letter_count(text: Column) -> Column:
    """Number of letters, which is also the number of trigrams ``word_trigrams`` gives."""
    return F.length(F.regexp_replace(F.lower(text), r"\P{L}+", "")).cast("long")


def word_trigrams(word: Column) -> Column:
    """The overlapping letter trigrams of one word padded with ``_`` at both ends."""
    padded = F.concat(F.lit("_"), word, F.lit("_"))
    return F.regexp_extract_all(padded, F.lit(r"(?=([_\p{L}]{3}))"), F.lit(1))


def decode_entities(text: Column) -> Column:
    """Character references as characters, in one pass; unknown ones stay. A text without ``&`` is passed on."""
    names = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, _REFERENCE, 1)
        code = F.when(F.rlike(name, F.lit("^#[0-9]")), F.substring(name, 2, 8).try_cast("bigint")).when(
            F.rlike(name, F.lit("^#[xX]")), F.conv(F.substring(name, 3, 7), 16, 10).try_cast("bigint")
        )
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
        value = F.coalesce(point, F.try_element_at(names, name))
        return F.coalesce(F.concat(value, F.substring(part, F.length(name) + 2, F.length(part))), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; none is left at either end."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def without_tags(html: Column) -> Column:
    """A page without tags, comments, scripts, styles and title; entities are left."""
    return F.regexp_replace(html, HTML_DROP, " ")


def html_text(html: Column) -> Column:
    """Visible text of a page."""
    return squeeze(decode_entities(without_tags(html)))


def without_hidden(html: Column) -> Column:
    """A page without scripts, styles and comments: a tag that only looks like one is gone."""
    return F.regexp_replace(html, _HIDDEN, " ")


def raw_title(page: Column) -> Column:
    return F.regexp_extract(page, rf"(?i)<title\b{_ATTRIBUTES}>([^<]*)", 1)


def meta_tags(page: Column) -> Column:
    """The attributes of every ``<meta>`` of a page."""
    return F.regexp_extract_all(page, F.lit(rf"(?i)<meta\b({_ATTRIBUTES})>"), F.lit(1))


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute in double, single or no quotes, ``''`` when absent."""
    pattern = rf"""(?is)(?:^|[\s"'/]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])


def raw_meta(tags: Column, name: str) -> Column:
    """The content of the first ``<meta>`` of that name, in any spelling; null when absent."""
    named = F.filter(tags, lambda tag: F.lower(F.trim(_attribute(tag, "name"))) == name)
    return _attribute(F.get(named, 0), "content")


def present(text: Column) -> Column:
    """Tidied text, null if nothing is left."""
    return F.nullif(squeeze(decode_entities(text)), F.lit(""))
