"""The exact split against a sort."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from salespipe.operators.split import exact_split


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 1000])
def test_test_rows_are_those_of_the_least_hashes(spark, n):
    train, test = exact_split(spark.range(n), "id")
    least = sorted(range(n), key=digest)[: -(-n // 4)]
    assert sorted(r.id for r in test.collect()) == sorted(least)
    assert sorted(r.id for r in train.collect()) == sorted(set(range(n)) - set(least))


def test_share_and_seed(spark):
    df = spark.range(400)
    _, half = exact_split(df, "id", share="1/3", seed=7)
    assert {r.id for r in half.collect()} == set(sorted(range(400), key=lambda k: digest(k, 7))[:134])
    assert exact_split(df, "id", share=0)[1].count() == 0 and exact_split(df, "id", share=1)[0].count() == 0
    with pytest.raises(ValueError):
        exact_split(df, "id", share=1.5)


def test_a_repeated_key_is_parted_by_its_rows_and_equal_rows_by_their_number(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 'hot', cast(id as string)) as k", "id % 7 as v")
    train, test = exact_split(df, "k")
    assert (train.count(), test.count()) == (750, 250)
    both = train.unionByName(test).groupBy("k", "v").count()
    assert both.exceptAll(df.groupBy("k", "v").count()).count() == 0
    # A value of the hot key is on both sides only where its equal rows are parted.
    hot = lambda side: {r.v for r in side.filter("k = 'hot'").collect()}
    assert len(hot(train) & hot(test)) <= 1
    same = spark.range(10).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("v"))
    train, test = exact_split(same, "k")
    assert (train.count(), test.count()) == (7, 3) and train.first() == test.first()


def test_nothing_is_sorted_or_moved(spark):
    _, test = exact_split(spark.range(5000), "id")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
