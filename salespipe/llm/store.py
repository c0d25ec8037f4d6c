"""Where steps of the operators cut their lineage: Parquet files in the shared folder.

A written table is read again as often as needed, survives lost executors and
keeps no executor memory.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from salespipe.session import scratch_dir


ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python a few megabytes at a time, unless the session says how many rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, ARROW_ROWS)


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run herein leave no files of their shuffles behind; else these stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written_by(spark: SparkSession, df: DataFrame, label: str, key: str) -> DataFrame:
    """As ``written``, with files dealt by ``key`` as a shuffle would deal the rows: a join on it moves only its other side."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"{label}_{uuid.uuid4().hex}", scratch_dir(spark, label)
    with shuffles_dropped(spark):
        df.repartition(parts, key).write.format("parquet").bucketBy(parts, key).option("path", path).saveAsTable(name)
    # The frame knows the files from here on; the name is not needed, and dropping it leaves them.
    found = spark.table(name)
    found.schema
    spark.sql(f"DROP TABLE `{name}`")
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
