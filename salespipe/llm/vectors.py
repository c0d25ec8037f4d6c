"""Adding up one vector per task, by a tree of tasks, so that the driver sees a bounded number of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.store import written

FAN = 32


def _add(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.int64) for v in rows.column("vector"))
    return pa.table({"part": [rows.column("up")[0].as_py()], "vector": [total.tobytes()]})


def summed(
    spark: SparkSession, df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int
) -> np.ndarray:
    """The sum over all tasks of ``count(batches)``, an int64 vector of ``length``."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"vector": [count(batches).astype(np.int64).tobytes()]})

    rows = df.mapInArrow(one, "vector binary").select(F.spark_partition_id().cast("long").alias("part"), "vector")
    rows = written(spark, rows, "vectors")
    while rows.count() > FAN:
        up = rows.withColumn("up", F.expr(f"part div {FAN}"))
        rows = written(spark, up.groupBy("up").applyInArrow(_add, "part long, vector binary"), "vectors")
    return sum((np.frombuffer(bytes(r.vector), np.int64) for r in rows.collect()), np.zeros(length, np.int64))
