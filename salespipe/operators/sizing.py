"""Size checks that decide whether a side of a join may be broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024

# Spark refuses broadcast relations of this many rows or more, whatever their size.
BROADCAST_MAX_ROWS = 100_000_000

# What Spark's hashed relation adds to a row: a pointer, and its places in a hash table that is kept at most half full and
# grows by doubling. The memory of the rows grows by doubling too.
RELATION_ROW_BYTES = 72
RELATION_GROWTH = 2


def row_bytes(schema: T.StructType) -> Column:
    """Bytes one row takes in memory: 16 per row, 8 per field (a decimal 16), and the text it holds."""
    parts = [F.lit(16)]
    for field in schema:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            as_text = F.to_json(F.struct(F.col(f"`{field.name}`").alias("v")))
            parts.append(F.coalesce(F.octet_length(as_text), F.lit(0)) + 16)
        else:
            parts.append(F.lit(16 if "decimal" in kind.simpleString() else 8))
    return reduce(lambda a, b: a + b, parts).cast("long")


def fits_broadcast(rows: int, size: int, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether rows of ``size`` bytes in all stay within the limit as a broadcast relation, as the driver holds it."""
    return rows < BROADCAST_MAX_ROWS and RELATION_GROWTH * size + RELATION_ROW_BYTES * rows <= limit


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) in one aggregate."""
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("size"),
    ).first()
    return found["rows"], found["size"]
