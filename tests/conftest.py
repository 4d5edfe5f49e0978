from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from polyad.session import local_session

    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def make(spark):
    """make(schema, rows): a small table."""
    from polyad.operators.schema import inline_table

    return lambda schema, rows: inline_table(spark, schema, rows)


def values(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])
