"""Reading stored tables and naming them for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The tables a finished run leaves behind.
TABLES = ["documents", "lang", "wordcount", "clusters"]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def name_table(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to SQL under ``name`` for this session."""
    df.createOrReplaceTempView(name)
    return df


def register_tables(
    spark: SparkSession, root: str, names: list[str] = TABLES, fmt: str = "parquet", external: bool = False, prefix: str = ""
) -> None:
    """Expose ``root/<name>`` to SQL as ``<prefix><name>``.

    By default these are session views. With ``external`` they become catalog tables over
    the same files; ``prefix`` may then be a database, ``run.``. A view or table that is there
    already is left alone and is an error.
    """
    for name in names:
        if external:
            spark.catalog.createTable(f"{prefix}{name}", path=f"{root}/{name}", source=fmt)
        else:
            read_table(spark, f"{root}/{name}", fmt).createTempView(f"{prefix}{name}")
