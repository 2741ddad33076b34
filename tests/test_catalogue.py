"""Every query against its SQL in DuckDB, value by value."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from finlake.plans import catalogue


def plain(value):
    if value is None:
        return ""
    return format(value.normalize() + 0, "f") if isinstance(value, Decimal) else str(value)


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_oracle(spark, sf, oracle, name):
    frame = catalogue.QUERIES[name](spark, sf)
    wanted = oracle.sql(catalogue.ORACLE_SQL[name])
    columns = sorted(frame.columns)
    assert columns == sorted(wanted.columns)
    at = [wanted.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in wanted.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
