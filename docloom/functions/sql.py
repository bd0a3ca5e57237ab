"""The one-expression functions under a name, for use inside SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docloom.functions.text import words_sql

_NAME = r"substring_index(translate(path, '\\', '/'), '/', -1)"

FUNCTIONS = {
    "extract_file_name": ("path STRING", "STRING", _NAME),
    "extract_extension": (
        "path STRING",
        "STRING",
        f"CASE WHEN contains({_NAME}, '.') THEN substring_index({_NAME}, '.', -1) ELSE '' END",
    ),
    "document_id": ("path STRING", "STRING", "sha2(path, 256)"),
    "path_to_words": ("path STRING", "STRING", r"translate(path, './\\_', '    ')"),
    "date_to_text": ("day TIMESTAMP", "STRING", "coalesce(date_format(day, 'yyyy-MM-dd'), '')"),
    "text_words": ("body STRING", "ARRAY<STRING>", words_sql("body")),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Register them for the session. Catalyst inlines their bodies."""
    for name, (argument, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS {result} RETURN {body}")
