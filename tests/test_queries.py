"""Every registered query against the same SQL run by DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from salespipe.plans import registry
from tests.conftest import DATA

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# Importing the contract registers them; those of the training-data operators have tests of their own.
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = df.collect()
    if name not in ORACLES:
        assert found
        return
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    wanted = sorted(repr(tuple(r[columns.index(c)] for c in df.columns)) for r in answer.fetchall())
    assert sorted(repr(tuple(r)) for r in found) == wanted


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
