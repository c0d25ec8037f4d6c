from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salespipe.operators import changes
from salespipe.operators.latest import latest_per_key

SCHEMA = "k int, v int, d int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, 10, 1), (1, 11, 1), (2, 20, 1), (None, 5, 1)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(1, 99, 2), (2, 0, 0), (3, 30, 2), (None, 7, 2)], SCHEMA)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_replace(target, source, rows, limit):
    got = rows(changes.upsert(target, source, "k", broadcast_limit=limit))
    assert got == [(None, 5, 1), (None, 7, 2), (1, 99, 2), (1, 99, 2), (2, 0, 0), (3, 30, 2)]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_if_newer(target, source, rows, limit):
    got = rows(changes.upsert(target, source, "k", on_match="if_newer", newer_by="d", broadcast_limit=limit))
    assert got == [(None, 5, 1), (None, 7, 2), (1, 99, 2), (1, 99, 2), (2, 20, 1), (3, 30, 2)]


def test_several_source_rows_for_one_target_row_raise(spark, target, source):
    twice = spark.createDataFrame([(1, 1, 1), (1, 2, 1)], SCHEMA)
    with pytest.raises(changes.AmbiguousMerge):
        changes.upsert(target, twice, "k")


@pytest.mark.parametrize("limit", [0, 10**6])
def test_repeated_keys_without_a_match_are_inserted(spark, target, rows, limit):
    twice = spark.createDataFrame([(8, 1, 1), (8, 2, 1), (None, 3, 3), (None, 3, 3)], SCHEMA)
    got = rows(changes.upsert(target, twice, "k", broadcast_limit=limit))
    assert got == rows(target.unionByName(twice))


def test_small_sources_leave_the_target_unshuffled(target, source):
    def plan(limit):
        kept = changes.merge_parts(target, source, "k", broadcast_limit=limit).kept
        return kept._jdf.queryExecution().executedPlan().toString()

    assert "Exchange hashpartitioning" not in plan(10**6) and "BroadcastHashJoin" in plan(10**6)


def test_source_columns(spark, target, rows):
    narrow = spark.createDataFrame([(1, 50), (4, 40)], "k int, v int")
    with pytest.raises(ValueError, match="lacks"):
        changes.upsert(target, narrow, "k")
    got = rows(changes.upsert(target, narrow, "k", missing="keep"))
    assert got == [(None, 5, 1), (1, 50, 1), (1, 50, 1), (2, 20, 1), (4, 40, None)]
    wide = spark.createDataFrame([("2", "x", 3, "left out")], "k string, v string, d int, e string")
    assert (2, None, 3) in rows(changes.upsert(target, wide, "k", cast="null"))
    with pytest.raises(Exception, match="cannot cast"):
        changes.upsert(target, wide, "k").collect()


def test_delete_keeps_rows_of_unknown_condition(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "k int, v int")
    assert rows(changes.delete_where(df, "v > 6")) == [(1, None), (2, 5)]
    assert rows(changes.delete_where(df, F.col("v").isNull())) == [(2, 5), (3, 9)]


def test_update(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert rows(changes.update_where(df, {"v": 0}, "v is null")) == [(1, 0), (2, 5)]
    assert rows(changes.update_where(df, {"v": F.col("v") + F.col("k")}, "k = 2")) == [(1, None), (2, 7)]
    with pytest.raises(ValueError, match="no such"):
        changes.update_where(df, {"w": 0}, "true")


def test_not_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert changes.require_not_null(df.filter("k = 1"), "k").count() == 1
    with pytest.raises(Exception, match="NOT NULL constraint failed: k"):
        changes.require_not_null(df, "k").collect()


def test_an_upsert_computes_its_source_once(spark, target, root):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(v):
        seen.add(1)
        return v

    source = spark.createDataFrame([(1, 5, 5), (9, 9, 9)], target.schema).withColumn("v", counted("v"))
    changes.upsert(target, source, "k").collect()
    assert seen.value == 2


def test_change_feed(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "k int, v string")
    got = rows(changes.change_feed(before, after, "k"))
    assert got == [(2, "x", "update"), (4, "d", "delete"), (5, "e", "insert")]
    wider = after.withColumn("w", F.lit(1))
    assert (1, "a", 1, "update") in rows(changes.change_feed(before, wider, "k"))


def test_change_feed_keeps_null_keys_out_of_its_joins(spark, rows):
    before = spark.createDataFrame([(1, "a"), (None, "x"), (None, "y")], "k int, v string")
    after = spark.createDataFrame([(1, "b"), (None, "x")], "k int, v string")
    feed = changes.change_feed(before, after, "k")
    assert rows(feed) == [(None, "x", "delete"), (None, "x", "insert"), (None, "y", "delete"), (1, "b", "update")]
    assert "FullOuter" not in feed._jdf.queryExecution().executedPlan().toString()
    for old, new in ((before, after.union(after)), (before.union(before), after)):
        with pytest.raises(Exception, match="repeated key"):
            changes.change_feed(old, new, "k").collect()


def test_row_difference(spark, rows):
    before = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    after = spark.createDataFrame([(1,), (3,), (3,), (None,)], "v int")
    assert rows(changes.row_difference(before, after)) == [(1, "delete", 1), (2, "delete", 1), (3, "insert", 2)]


# ----------------------------------------------------------------- properties

some_rows = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9), st.integers(0, 3)), max_size=12)
few = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def newest(spark, data):
    return latest_per_key(spark.createDataFrame(data, SCHEMA), "k", "d", ties="one", tie_break="v")


NEWER = {"on_match": "if_newer", "newer_by": ["d", "v"]}


@few
@given(a=some_rows, b=some_rows)
def test_upserting_twice_is_upserting_once(spark, rows, a, b):
    t, s = newest(spark, a), newest(spark, b)
    once = changes.upsert(t, s, "k")
    assert rows(changes.upsert(once, s, "k")) == rows(once)


@few
@given(a=some_rows, b=some_rows)
def test_if_newer_does_not_depend_on_the_batches(spark, rows, a, b):
    empty = spark.createDataFrame([], SCHEMA)
    ab = changes.upsert(changes.upsert(empty, newest(spark, a), "k", **NEWER), newest(spark, b), "k", **NEWER)
    ba = changes.upsert(changes.upsert(empty, newest(spark, b), "k", **NEWER), newest(spark, a), "k", **NEWER)
    assert rows(ab) == rows(ba) == rows(newest(spark, a + b))


@few
@given(a=some_rows, b=some_rows)
def test_applying_the_change_feed_gives_the_new_state(spark, rows, a, b):
    old, new = newest(spark, a), newest(spark, b)
    feed = changes.change_feed(old, new, "k")
    gone = feed.filter("_change = 'delete'").select("k")
    applied = changes.upsert(old.join(gone, "k", "left_anti"), feed.filter("_change <> 'delete'").drop("_change"), "k")
    assert rows(applied) == rows(new)


def test_a_source_of_many_narrow_rows_is_not_sent_through_the_driver(spark):
    source = spark.range(500_000).selectExpr("id AS k", "id AS d", "id AS v")
    halves = changes.merge_parts(source.limit(10), source, "k")
    assert not halves.source_broadcast
    assert changes.merge_parts(source.limit(10), source.limit(1000), "k").source_broadcast
