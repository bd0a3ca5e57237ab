"""Run registered queries and their SQL side by side: python tests/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    """Rows as text, columns and rows in order, so that only the values count."""

    def text(value) -> str:
        if value is None or value is pd.NaT or (isinstance(value, float) and pd.isna(value)):
            return "NULL"
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, float):
            return repr(value + 0.0)
        return str(value)

    columns = [[text(v) for v in frame[c].astype(object)] for c in sorted(frame.columns)]
    return sorted(zip(*columns))


def differences(found: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(found.columns) != sorted(expected.columns):
        return f"columns {sorted(found.columns)} and {sorted(expected.columns)}"
    kinds = {c: (found[c].dtype.kind, expected[c].dtype.kind) for c in found.columns}
    off = {c: k for c, k in kinds.items() if k[0] != k[1] and "O" not in k and len(found)}
    if off:
        return f"types {off}"
    a, b = canonical(found), canonical(expected)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} and {len(b)} rows\n  Spark only {str(only_a)[:700]}\n  SQL only   {str(only_b)[:700]}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from docloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, make in queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            found = make(spark, sf_dir).toPandas()
            middle = time.time()
            problem, rows = None, len(found)
            if name in sql:
                expected = db.execute(sql[name]).df()
                problem = differences(found, expected)
            state = "FAIL" if problem else ("ok" if name in sql else "rows only")
            print(f"{state:9} {name:20} {rows:8} rows  spark {middle - start:6.2f}s  sql {time.time() - middle:6.2f}s", flush=True)
        except Exception as error:
            problem = str(error)[:1500]
            print(f"ERROR     {name}", flush=True)
        if problem:
            bad += 1
            print("  " + problem, flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
