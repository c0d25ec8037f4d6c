"""Names of the test tables' columns in the roles the operators need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_if(column: str, value) -> Column:
    return F.nullif(F.col(column), F.lit(value))


def lines_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in which a zero discount is unknown."""
    return load(spark, sf_dir, "lineitem").withColumn("l_discount", null_if("l_discount", 0.0))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
