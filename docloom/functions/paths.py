"""Column functions over file paths, ids and dates. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """The part after the last ``/`` or ``\\``."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def file_extension(path: Column) -> Column:
    """The part after the last dot of the file name, case kept; ``''`` without a dot."""
    name = file_name(path)
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1)).otherwise(F.lit(""))


def has_extension(path: Column, *extensions: str) -> Column:
    """Case-insensitive test of the extension."""
    return F.lower(file_extension(path)).isin(*[e.lower() for e in extensions])


def doc_id(path: Column) -> Column:
    """The index id of a document: hex SHA-256 of its path."""
    return F.sha2(path, 256)


def path_words(path: Column) -> Column:
    """The path with ``. / \\ _`` turned into blanks, so that it can be searched as text."""
    return F.translate(path, "./\\_", "    ")


def result_link(path: Column) -> Column:
    """A clickable address for a hit."""
    return F.concat(F.lit("file://"), F.translate(path, "\\", "/"))


def date_text(value: Column) -> Column:
    """``yyyy-MM-dd``, or ``''`` when the date is missing."""
    return F.coalesce(F.date_format(value, "yyyy-MM-dd"), F.lit(""))
