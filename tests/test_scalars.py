from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salespipe.functions import scalars
from salespipe.functions.conform import conform, schema_differences


def one(df):
    return [r[0] for r in df.collect()]


def check_ratio(spark):
    df = spark.createDataFrame([(10, 0), (10, 4), (None, 4)], "a long, b long")
    assert one(df.select(scalars.safe_ratio("a", "b"))) == [None, 2.5, None]


def test_ratio(spark):
    check_ratio(spark)


def test_ratio_without_ansi(spark, ansi_off):
    check_ratio(spark)


def test_truncation_is_toward_zero(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (1e12,), (None,)], "x double")
    assert one(df.select(scalars.truncate_to_int("x"))) == [1, -1, None, None]


def test_bad_numbers_and_times_are_null(spark):
    df = spark.createDataFrame([("1.5", "2015-07-31"), ("a", "soon"), (None, None)], "n string, t string")
    assert one(df.select(scalars.coerce_number("n"))) == [1.5, None, None]
    assert one(df.select(scalars.parse_timestamp("t"))) == [dt.datetime(2015, 7, 31), None, None]
    assert one(df.limit(1).select(scalars.parse_timestamp(F.lit("31/07/2015"), "dd/MM/yyyy"))) == [
        dt.datetime(2015, 7, 31)
    ]


def test_names(spark):
    df = spark.createDataFrame([("jo.do@x--y.org",), ("a_b",)], "s string")
    assert one(df.select(scalars.sanitize_name("s"))) == ["jo_do_x_y_org", "a_b"]


def test_day_label(spark):
    assert one(spark.range(1).select(scalars.day_label(dt.date(2021, 3, 4)))) == ["2021-03-04"]
    assert len(one(spark.range(1).select(scalars.day_label()))[0]) == 10


def test_hash_percent_is_stable(spark):
    a = spark.range(1000).select(scalars.hash_percent("id"))
    b = spark.range(1000).repartition(7).select("id", scalars.hash_percent("id").alias("p")).orderBy("id").select("p")
    assert one(a) == one(b)
    assert 650 < sum(p < 75 for p in one(a)) < 850


def check_conform_policies(spark):
    df = spark.createDataFrame([("1", 5), ("c", 6)], "b string, a long")
    lenient = conform(df, "a int, b int, c string", cast="null", missing="null")
    assert lenient.dtypes == [("a", "int"), ("b", "int"), ("c", "string")]
    assert [tuple(r) for r in lenient.collect()] == [(5, 1, None), (6, None, None)]
    with pytest.raises(Exception, match="cannot cast to int: c"):
        conform(df, "b int").collect()
    with pytest.raises(ValueError, match="missing"):
        conform(df, "z int")


def test_conform(spark):
    check_conform_policies(spark)


def test_conform_without_ansi(spark, ansi_off):
    check_conform_policies(spark)


def test_schema_differences(spark):
    a = spark.createDataFrame([], "x int, y string").schema
    b = spark.createDataFrame([], "x long, z string").schema
    assert schema_differences(a, b) == ["missing column z", "new column y", "column x is int, not bigint"]
