"""Streams of versions and of files whose schemas change: restarts, replays, failures."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQueryException

from salespipe.streaming import appended
from salespipe.streaming.upsert import upsert_batch
from salespipe.tables.versioned import VersionedTable

SCHEMA = "k int, t int, v int"


@pytest.fixture
def source(spark, root):
    return VersionedTable.create(spark, f"{root}/source", SCHEMA)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_versions_are_streamed_once_and_in_order_across_restarts(spark, source, root):
    seen = []

    def run():
        def apply(rows, batch_id):
            seen.append(sorted(r.k for r in rows.collect()))

        appended.stream_appends(source, apply, f"{root}/cp", versions_per_batch=1).awaitTermination()

    for i in range(3):
        source.append(frame(spark, (i, 0, 0)))
    run()
    assert seen == [[], [0], [1], [2]], "version 0 is empty"
    run()
    assert len(seen) == 4
    source.append(frame(spark, (7, 0, 0), (8, 0, 0)))
    source.delete("k = 99")  # changes nothing
    run()
    assert [s for s in seen[4:] if s] == [[7, 8]]


def test_a_batch_that_comes_again_has_no_effect(spark, source, root):
    target = VersionedTable.create(spark, f"{root}/target", SCHEMA)
    apply = upsert_batch(target, "k", "t", tie_break="v", stream_id="s")
    rows = frame(spark, (1, 1, 1))
    apply(rows, 0)
    version = target.version()
    apply(rows, 0)
    assert target.version() == version


def test_a_failed_batch_is_read_again(spark, source, root):
    source.append(frame(spark, (1, 1, 1)))
    seen = []

    def fail(rows, batch_id):
        raise RuntimeError("half way")

    with pytest.raises(StreamingQueryException):
        appended.stream_appends(source, fail, f"{root}/cp").awaitTermination()
    appended.stream_appends(source, lambda rows, i: seen.extend(r.k for r in rows.collect()), f"{root}/cp").awaitTermination()
    assert seen == [1]


def test_a_version_that_rewrote_rows_stops_the_stream(spark, source, root):
    source.append(frame(spark, (1, 1, 1), (2, 2, 2)))
    source.update({"v": 0}, "k = 1")
    with pytest.raises(StreamingQueryException, match="NotAppended|no append"):
        appended.stream_appends(source, lambda rows, i: rows.count(), f"{root}/cp").awaitTermination()


def test_types_columns_and_rescued_values(spark, root):
    landing, cp = f"{root}/landing", f"{root}/cp"

    def land(rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)

    def run():
        appended.stream_files(spark, landing, lambda rows, i: rows.write.mode("append").parquet(f"{root}/out"), cp).awaitTermination()

    land([(1, 5)], "id long, n long")
    run()
    land([(2, "five", 0.5)], "id long, n string, x float")
    land([(3, None, None)], "id long, n string, x float")
    land([(4, 7)], "id int, n int")
    run()
    run()
    assert appended.kept_schema(spark, cp) == T.StructType.fromDDL("id long, n long, x float")
    out = spark.read.schema("id long, n long, x float, _rescued string").parquet(f"{root}/out")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5, None, None), (2, None, 0.5, '{"n":"five"}'), (3, None, None, None), (4, 7, None, None)]
