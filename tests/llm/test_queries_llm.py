"""Registered queries against their SQL, over the whole small tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from salespipe.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def plain(values):
    return [None if v is None or (isinstance(v, float) and math.isnan(v)) else v for v in values]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, sql, name):
    got = QUERIES[name](spark, DATA)
    want = sql.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(plain(r)) for r in want.fetchall()]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(plain(r))) for r in got.select(*columns).collect())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
