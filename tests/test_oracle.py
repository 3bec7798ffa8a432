"""Every query with SQL against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from pixsieve.catalog import ORACLE_SQL, QUERIES

from conftest import SF_DIR

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}

@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_queries_and_sql_have_the_same_names():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    expected = tables.execute(entry.oracle_sql()[name])
    columns = {d[0]: str(d[1]) for d in expected.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    names = sorted(columns)
    place = [list(columns).index(n) for n in names]
    want = sorted((tuple(r[i] for i in place) for r in expected.fetchall()), key=repr)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert got == want and len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 200
