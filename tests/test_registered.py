"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload import oracle, queries

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(smallest):
    con = duckdb.connect()
    for path in Path(smallest).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_sql():
    """Those of the library itself; text operators without SQL are tested in their own folder."""
    assert queries.registered().keys() == oracle.oracle_sql().keys()
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, smallest, name):
    df = QUERIES[name](spark, smallest)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(
        str([plain(dict(zip(names, row))[c]) for c in columns]) for row in result.fetchall())
    assert got == expected and got


def test_entry(spark):
    assert contract.entry(spark).count() == 100
