"""Latest per key, lookups, category codes and profiles on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salespipe.operators import profile
from salespipe.operators.encode import category_codes, category_codes_of
from salespipe.operators.latest import latest_by_maximum, latest_per_key
from salespipe.operators.lookup import enrich, join_lookup
from salespipe.operators.sizing import fits_broadcast, measure
from salespipe.operators.split import hash_split


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, 10, "a"), (1, 12, "b"), (1, 12, "c"), (2, 5, "d"), (2, None, "e"), (3, None, "f"), (None, 1, "g")],
        "k int, t int, v string",
    )


def test_ties_all(sales, rows):
    wanted = [(None, 1, "g"), (1, 12, "b"), (1, 12, "c"), (2, 5, "d"), (3, None, "f")]
    assert rows(latest_per_key(sales, "k", "t")) == wanted
    assert rows(latest_per_key(sales, "k", "t", few_ties=True)) == wanted


def test_ties_one(sales, rows):
    got = rows(latest_per_key(sales, "k", "t", ties="one", tie_break="v"))
    assert got == [(None, 1, "g"), (1, 12, "c"), (2, 5, "d"), (3, None, "f")]
    with pytest.raises(ValueError, match="tie_break"):
        latest_per_key(sales, "k", "t", ties="one")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(latest_per_key(df, "k", "id", few_ties=True))
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_a_hot_key_with_masses_of_ties(spark):
    hot = spark.range(30000).select(F.lit(7).alias("k"), F.lit(1).alias("t"), "id")
    rest = spark.range(30000).select((F.col("id") % 1000 + 10).alias("k"), (F.col("id") % 50).alias("t"), "id")
    df = hot.unionByName(rest)
    assert latest_by_maximum(df, "k", "t").filter("k = 7").count() == 30000
    assert latest_by_maximum(df, "k", "t").exceptAll(latest_per_key(df, "k", "t", few_ties=True)).count() == 0


def test_lookups_drop_unmatched_rows_and_keep_the_key_once(spark, sales, rows):
    names = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    towns = spark.createDataFrame([(1, "x"), (9, "y")], "k int, town string")
    got = enrich(sales, (names, "k"), (towns, ["k"]))
    assert got.columns == ["k", "t", "v", "name", "town"]
    assert rows(got, "k", "v", "town") == [(1, "a", "x"), (1, "b", "x"), (1, "c", "x")]
    assert rows(join_lookup(sales, names, "k", salt=3, salt_by="v")) == rows(join_lookup(sales, names, "k"))


def test_salting_splits_a_key(spark):
    hot = spark.range(8000).select(F.lit(1).alias("k"), "id")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_lookup(hot, names.hint("merge"), "k", salt=8, salt_by="id")
        with pytest.raises(ValueError, match="salt_by"):
            join_lookup(hot, names, "k", salt=8)
        assert joined.count() == 8000
        assert joined.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_category_codes(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["c", "a", "0", None, "a"])], "i int, v string")
    wanted = [(0, 2), (1, 1), (2, 0), (3, -1), (4, 1)]
    assert rows(category_codes(df, "v", "code"), "i", "code") == wanted
    assert category_codes(df, "v").columns == ["i", "v", "v_code"]


def test_category_codes_of_many_values(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("v"))
    coded = category_codes(df, "v", "c")
    assert coded.agg(F.min("c"), F.max("c"), F.count_distinct("c")).first()[:] == (0, 4999, 5000)
    order = [r.c for r in coded.orderBy("v").collect()]
    assert order == list(range(5000))


def test_null_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(profile.null_counts(df)) == [("a", 1), ("b", 2)]
    assert profile.null_count(df, "a").first().asDict() == {"a_NULL": 1}
    assert profile.null_count(df.limit(0), "a").first()[0] is None


def check_constant_column(spark, rows):
    df = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0), (1, None, 2.0)], "a int, b int, c double")
    got = {(r.x, r.y): r.r for r in profile.correlation_matrix(df).collect()}
    assert len(got) == 9 and got["a", "a"] is None and got["a", "b"] is None
    assert got["b", "b"] == pytest.approx(1) and got["b", "c"] == got["c", "b"] == pytest.approx(-0.5)
    paired = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, ["b", "c"], fill=None).collect()}
    assert paired["b", "c"] == pytest.approx(-1)


def test_correlation(spark, rows):
    check_constant_column(spark, rows)


def test_correlation_without_ansi(spark, rows, ansi_off):
    check_constant_column(spark, rows)


def test_correlations_take_two_passes_for_any_number_of_columns(spark):
    wide = spark.range(200).select(*[((F.col("id") * (i + 3)) % 101 + i).alias(f"c{i}") for i in range(40)])
    matrix = profile.correlation_matrix(wide)
    # The means came with the call; what is left reads the rows once.
    assert matrix._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2, "cells, and spreads from the same sums"
    got = {(r.x, r.y): r.r for r in matrix.collect()}
    exact = wide.toPandas().corr()
    assert len(got) == 1600 and all(got[x, y] == pytest.approx(exact[x][y]) for x, y in got)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    got = profile.regression_metrics(df, "y", "p").first()
    assert (got.n, got.mae, got.mse, got.r2) == (3, pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(0.5))
    assert profile.regression_metrics(df.limit(1), "y", "p").first().r2 is None


def test_monthly_labels(spark):
    df = spark.sql("select timestamp'2015-02-10 01:00:00' t, 2 v union all select timestamp'2015-02-28 23:00:00', 3")
    got = profile.monthly(df, "t", F.sum("v").alias("v")).collect()
    assert [(str(r.month_start), str(r.month_end), r.v) for r in got] == [("2015-02-01", "2015-02-28", 5)]


def test_split_is_whole_and_disjoint(spark):
    df = spark.range(2000)
    train, test = hash_split(df, "id")
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0


def test_measured_size_grows_with_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "s string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "s string")
    assert measure(short)[0] == 10 and measure(long)[1] > measure(short)[1] + 9000
    assert fits_broadcast(10, 100) and not fits_broadcast(10, 10**10) and not fits_broadcast(10**9, 1)


def test_a_broadcast_is_measured_as_the_relation_the_driver_holds(spark):
    # 24 MB of rows, but above 80 MB as a hashed relation with its table of keys.
    many = spark.range(500_000).selectExpr("id AS k", "id AS a", "id AS b", "id AS c")
    assert not fits_broadcast(*measure(many))
    assert fits_broadcast(*measure(many.limit(100_000)))


def test_pairwise_correlations_take_two_passes_and_leave_out_rows_with_a_null(spark):
    value = lambda i: F.when((F.col("id") * 7 + i) % (i + 4) != 0, (F.col("id") * (i + 3)) % 101 + i)
    wide = spark.range(300).select(*[value(i).alias(f"c{i}") for i in range(40)])
    matrix = profile.correlation_matrix(wide, fill=None)
    # The means came with the call; what is left reads the rows once.
    assert matrix._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    got = {(r.x, r.y): r.r for r in matrix.collect()}
    exact = wide.toPandas().astype(float).corr(min_periods=2)
    assert len(got) == 1600 and all(got[x, y] == pytest.approx(exact[x][y], abs=1e-9) for x, y in got)


def test_pairwise_correlations_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 0.1, None, 1), (2.0, 0.1, None, 2), (3.0, None, None, 3), (None, 0.3, 5.0, 4)], "a double, b double, c double, d int")
    got = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, fill=None).collect()}
    # b is constant where a is known, but not by itself; c has one value only.
    assert got["a", "b"] is None and got["b", "b"] == pytest.approx(1) and got["a", "d"] == pytest.approx(1)
    assert all(got["c", x] is None for x in "abcd")
    assert all(r.r is None for r in profile.correlation_matrix(df.limit(0), fill=None).collect())


def test_codes_of_many_columns_at_once(spark, rows):
    df = spark.sql("""
        select * from values
          (1, 'c', 10, 2.5D, date'2024-01-02', timestamp_ntz'2024-03-31 02:30:00.5', true),
          (2, 'a', 9, -1.0D, date'2023-01-02', timestamp_ntz'2024-03-31 03:30:00', false),
          (3, null, null, null, null, null, null),
          (4, 'b', 100, 10.0D, date'2024-01-02', timestamp_ntz'2024-03-31 02:30:00.05', true) as t(i, s, n, x, d, t, f)
    """)
    got = category_codes_of(df, ["s", "n", "x", "d", "t", "f"])
    assert got.columns == [*df.columns, *[f"{c}_code" for c in "snxdtf"]]
    assert rows(got, "i", *[f"{c}_code" for c in "snxdtf"]) == [
        (1, 2, 1, 1, 1, 1, 1), (2, 0, 0, 0, 0, 2, 0), (3, -1, -1, -1, -1, -1, -1), (4, 1, 2, 2, 1, 0, 1),
    ]
    wide = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("v"), (F.col("id") % 17).alias("w"))
    coded = category_codes_of(wide, ["w", "v"]).agg(F.count_distinct("v_code"), F.max("v_code"), F.max("w_code")).first()
    assert coded[:] == (3000, 2999, 16)
    with pytest.raises(ValueError):
        category_codes_of(df.withColumn("a", F.array("i")), ["a"])
