"""Batch sinks and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.functions.conform import as_struct
from salespipe.functions.scalars import month_key
from salespipe.sources import storage


def overwrite_path(df: DataFrame, path: str, *, files: int | None = None) -> None:
    """Replace a parquet folder; ``files`` spreads the rows evenly over that many files."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, name: str, *, path: str | None = None) -> None:
    """Create or replace a catalog table from a query, also with another schema."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_monthly(df: DataFrame, when: str, path: str, *, month: str = "month") -> None:
    """One folder per calendar month, ``month=yyyy-MM``.

    The rebalance hint brings a month's rows together, so that a folder gets
    few files, and lets adaptive execution split a month too big for one task.
    """
    keyed = df.withColumn(month, month_key(when))
    keyed.hint("rebalance", F.col(month)).write.mode("overwrite").partitionBy(month).parquet(path)


def read_monthly(spark: SparkSession, path: str, schema: T.StructType | str, *, month: str = "month") -> DataFrame:
    """The folder of ``write_monthly``; a filter on ``month`` opens only those folders."""
    declared = T.StructType([*as_struct(schema).fields, T.StructField(month, T.StringType())])
    return spark.read.schema(declared).parquet(path)


def create_database(spark: SparkSession, name: str, location: str, *, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    if use:
        spark.sql(f"USE `{name}`")


def create_table(spark: SparkSession, name: str, schema: T.StructType | str, location: str | None = None) -> None:
    """Create an empty typed parquet table, unless it is there."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in as_struct(schema))
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{place}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def reset(spark: SparkSession, tables: list[str], paths: list[str]) -> None:
    """Forget tables, their data folders and stream checkpoints, so that a run starts afresh."""
    for name in tables:
        drop_table(spark, name)
    for path in paths:
        storage.delete_folder(spark, path)
