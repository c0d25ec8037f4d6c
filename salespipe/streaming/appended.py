"""Streams whose micro-batches are read by their own lists of files: versioned tables, and folders of changing schemas."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salespipe.sources import storage
from salespipe.streaming.triggers import with_trigger
from salespipe.tables.versioned import VersionedTable

RESCUED = "_rescued"
_FILE = "path string, modificationTime timestamp, length long, content binary"
# What a stored type takes in without loss.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"}, "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"}, "float": {"double"}, "date": {"timestamp_ntz"},
}

Apply = Callable[[DataFrame, int], None]


def stream_appends(
    table: VersionedTable, apply: Apply, checkpoint: str, *, versions_per_batch: int = 20, every: str | None = None
) -> StreamingQuery:
    """Call ``apply(rows, batch_id)`` with the rows that new versions of a table appended.

    The commit files are the stream, so the checkpoint holds which versions are
    done, and a restart goes on with the next. A batch opens the parts its versions
    appended and nothing else. A version that rewrote or removed rows
    fails the stream (``NotAppended``). After a failure a batch may come again under its
    id, as with any ``foreachBatch``; ``upsert_batch`` leaves such a batch out.
    """
    source = table.spark.readStream.schema("version long").option("maxFilesPerTrigger", versions_per_batch)

    def run(batch: DataFrame, batch_id: int) -> None:
        versions = sorted(r["version"] for r in batch.collect())
        if versions:
            apply(table.appended_by(versions), batch_id)

    writer = source.json(f"{table.root}/commits").writeStream.option("checkpointLocation", checkpoint)
    return with_trigger(writer.foreachBatch(run), every).start()


# ------------------------------------------------------------ kept schemas


def kept_schema(spark: SparkSession, checkpoint: str) -> T.StructType | None:
    """The schema a stream of files has had so far."""
    path = f"{checkpoint}/kept-schema.json"
    return T.StructType.fromJson(json.loads(storage.read_text(spark, path))) if storage.exists(spark, path) else None


def widened(kept: T.StructType | None, found: T.StructType) -> T.StructType:
    """The kept columns with their types, then the new ones."""
    have = list(kept.fields) if kept else []
    names = {f.name for f in have}
    return T.StructType(have + [T.StructField(f.name, f.dataType) for f in found if f.name not in names])


def fitted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the columns of a schema; values of a type it does not take go, as JSON, to the column ``_rescued``."""
    own = {f.name: f.dataType for f in rows.schema}
    odd = [
        f.name for f in schema
        if f.name in own and own[f.name] != f.dataType and f.dataType.simpleString() not in _WIDER.get(own[f.name].simpleString(), ())
    ]
    columns = [
        (F.col(f"`{f.name}`") if f.name in own and f.name not in odd else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    kept = [F.col(f"`{c}`") for c in odd]
    any_odd = reduce(lambda a, b: a | b, [c.isNotNull() for c in kept], F.lit(False))
    rescued = F.when(any_odd, F.to_json(F.struct(*kept))) if kept else F.lit(None)
    return rows.select(*columns, rescued.cast("string").alias(RESCUED))


def stream_files(
    spark: SparkSession, path: str, apply: Apply, checkpoint: str, *, files_per_batch: int = 20, every: str | None = None
) -> StreamingQuery:
    """Call ``apply(rows, batch_id)`` with the parquet files that landed in a folder, each once, without a declared schema.

    The schema is kept beside the checkpoint and outlives restarts: columns keep the type they came with first, new ones
    are added when a file brings them, and values of another type are rescued instead of failing the stream.
    """
    files = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", files_per_batch).load(path)

    def run(batch: DataFrame, batch_id: int) -> None:
        # Paths only: the contents are read as parquet below. Files of one schema are read together.
        groups: dict[str, list[str]] = {}
        for name in sorted(r["path"] for r in batch.select("path").collect()):
            groups.setdefault(spark.read.parquet(name).schema.json(), []).append(name)
        if not groups:
            return
        schema = kept_schema(spark, checkpoint)
        for found in groups:
            schema = widened(schema, T.StructType.fromJson(json.loads(found)))
        # Before the rows: a batch that comes again finds the same types.
        storage.overwrite_text(spark, f"{checkpoint}/kept-schema.json", schema.json())
        parts = [fitted(spark.read.parquet(*names), schema) for names in groups.values()]
        apply(reduce(DataFrame.unionByName, parts), batch_id)

    writer = files.select("path").writeStream.option("checkpointLocation", checkpoint)
    return with_trigger(writer.foreachBatch(run), every).start()
