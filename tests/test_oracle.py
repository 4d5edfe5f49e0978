"""Every registered query against its SQL twin on the smallest driver tables."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return "decimal"
    if isinstance(value, float):
        return "NULL" if value != value else repr(value + 0.0)
    if isinstance(value, datetime.date):
        return value.isoformat()[:10]
    return "NULL" if value is None else f"{type(value).__name__}:{value}"


def table(arrow):
    names = sorted(arrow.column_names)
    return names, sorted(tuple(plain(v) for v in row) for row in zip(*[arrow.column(n).to_pylist() for n in names], strict=True))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck):
    found = table(QUERIES[name](spark, str(DATA)).toArrow())
    if name in ORACLE:
        assert found == table(duck.sql(ORACLE[name]).to_arrow_table())
    else:
        assert found[1]


def test_only_sampling_lacks_an_oracle():
    assert set(QUERIES) - set(ORACLE) == {"impute_sampled"}
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()
    assert entry.entry(spark).limit(1).count() == 1
