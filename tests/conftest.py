from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salespipe.session import local_session  # noqa: E402

DATA = os.environ.get("SALESPIPE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, NULLs first."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])

    return collect


@pytest.fixture
def ansi_off(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)
