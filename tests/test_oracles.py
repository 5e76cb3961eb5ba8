"""Every registered query on the smallest tables, next to its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import rows

TABLES = Path("/root/testdata/sf0.001")
ORACLES = oracle_sql()

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", queries())
def test_query(spark, duck, name):
    df = queries()[name](spark, str(TABLES))
    got = rows(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 5


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())
