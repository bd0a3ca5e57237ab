"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest
from check import connect, differences

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SMOKE_DIR)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_sql_belongs_to_registered_queries():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    found = queries()[name](spark, SMOKE_DIR).toPandas()
    assert len(found) > 0
    if name in SQL:
        assert differences(found, db.execute(SQL[name]).df()) is None
