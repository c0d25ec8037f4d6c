"""Scans: files with a declared schema, file streams, and table streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, merge_schema: bool = False
) -> DataFrame:
    """Columns match by name; a declared column the files lack reads as NULL."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row; cells that do not fit the schema read as NULL.

    Without a schema Spark reads the files once more to infer one.
    """
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str, *, array: bool = False) -> DataFrame:
    """Records as one JSON object per line, or (``array``) as one JSON array per file.

    An array file cannot be split and is read by one task, so large inputs
    should come as many files or as lines.
    """
    return spark.read.schema(schema).option("multiLine", array).json(path)


def column_types(df: DataFrame) -> DataFrame:
    """(position, column_name, column_type) of a table, as a table."""
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.sparkSession.range(1).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, files_per_batch: int | None = None
) -> DataFrame:
    """Each file that lands in a folder once; ``files_per_batch`` limits a micro-batch.

    Without a schema it is inferred from the files already there.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    inferred = spark.read.parquet(path).schema
    return reader.schema(inferred).parquet(path)


def stream_table(spark: SparkSession, name: str, *, files_per_batch: int | None = None) -> DataFrame:
    """The rows appended to a catalog table, as a stream."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.table(name)
