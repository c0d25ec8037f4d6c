"""Streaming append to a catalog table or a parquet folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salespipe.streaming.triggers import with_trigger
from salespipe.tables.versioned import SchemaMismatch


def append_to_table(
    stream: DataFrame, table: str, checkpoint: str, *, every: str | None = None, path: str | None = None
) -> StreamingQuery:
    """Append each micro-batch to a table, which is made on first use.

    The checkpoint holds the progress, so a restarted run goes on with the
    files it has not seen; a table and its checkpoint belong together. ``path``
    makes it an external table. Columns the table lacks are added to it first
    and are NULL in its old rows; a column of another type raises.
    """
    widen_table(stream.sparkSession, table, stream.schema)
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    return with_trigger(writer, every).toTable(table)


def widen_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Add to an existing table the columns of ``schema`` that it lacks."""
    if not spark.catalog.tableExists(table):
        return
    have = {f.name.lower(): f for f in spark.table(table).schema}
    changed = [f.name for f in schema if f.name.lower() in have and have[f.name.lower()].dataType != f.dataType]
    if changed:
        raise SchemaMismatch(f"columns of another type in {table}: {changed}")
    new = [f for f in schema if f.name.lower() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def append_to_path(
    stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start(path)
