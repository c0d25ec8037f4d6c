"""Category codes: the rank of a value among the sorted distinct values, of one column or of many at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.operators.sizing import fits_broadcast, measure
from salespipe.session import ensure_checkpoint_dir

NULL_CODE = -1


def category_vocabulary(df: DataFrame, column: str, code: str) -> tuple[DataFrame, bool]:
    """((value, code) with codes 0..n-1 in sorted order, whether it may be broadcast).

    Distinct values are found once and kept; sorted ranges of them are numbered
    inside and then shifted, so no task sees them all, however many there are.
    """
    ensure_checkpoint_dir(df.sparkSession)
    values = df.select(column).filter(F.col(column).isNotNull()).distinct().checkpoint()
    placed = (
        values.repartitionByRange(column)
        .sortWithinPartitions(column)
        .withColumn("__place", F.monotonically_increasing_id())
        # The range borders come from a sample; the checkpoint pins them.
        .checkpoint()
    )
    # The generated id holds the partition above bit 33 and the row's place below it.
    placed = placed.select(
        column,
        F.shiftright("__place", 33).alias("__range"),
        F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"),
    )
    # One row per range, that is per shuffle partition.
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    coded = placed.join(F.broadcast(starts), "__range").select(
        column, (F.col("__start") + F.col("__at")).alias(code)
    )
    return coded, fits_broadcast(*measure(values))


def category_codes(df: DataFrame, column: str, code: str | None = None) -> DataFrame:
    """Add the code of ``column``; NULL gets -1."""
    code = code or f"{column}_code"
    vocabulary, may_broadcast = category_vocabulary(df, column, code)
    coded = df.join(F.broadcast(vocabulary) if may_broadcast else vocabulary, column, "left")
    return coded.select(*df.columns, F.coalesce(F.col(code), F.lit(NULL_CODE)).cast("long").alias(code))


# How a value of each kind sorts: as a whole number, as a fraction, or as text.
_WHOLE = (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_FRACTION = (T.FloatType, T.DoubleType)


def _kind(field: T.StructField) -> str:
    for kind, types in (("n", _WHOLE), ("x", _FRACTION), ("s", (T.StringType,))):
        if isinstance(field.dataType, types):
            return kind
    raise ValueError(f"{field.name}: values of type {field.dataType.simpleString()} have no category codes")


def _sorting(field: T.StructField) -> list[Column]:
    """A value as (whole number, fraction, text), of which one is set: values of all columns sort in one table."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampNTZType):
        # By its parts: as an instant it would depend on the session's time zone.
        seconds = (F.hour(c) * 3600 + F.minute(c) * 60).cast("decimal(20,6)") + F.expr(f"extract(SECOND FROM `{field.name}`)")
        whole = F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + (seconds * 1_000_000).cast("long")
    elif isinstance(field.dataType, T.TimestampType):
        whole = F.unix_micros(c)
    else:
        whole = F.unix_date(c) if isinstance(field.dataType, T.DateType) else c
    values = {"n": (whole, "long"), "x": (c, "double"), "s": (c, "string")}
    return [(v if k == _kind(field) else F.lit(None)).cast(kind) for k, (v, kind) in values.items()]


def category_codes_of(df: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Add the codes of several columns, found in one pass over the table; NULL gets -1.

    One distinct of (column, value), one sort by ranges for all columns; a place
    within its range, shifted by the ranges before and less those of the columns
    before, is the code.
    """
    ensure_checkpoint_dir(df.sparkSession)
    fields = [df.schema[c] for c in columns]
    values = [F.struct(F.lit(i).alias("of"), *[k.alias(n) for k, n in zip(_sorting(f), "nxs", strict=True)]) for i, f in enumerate(fields)]
    known = F.col("v.n").isNotNull() | F.col("v.x").isNotNull() | F.col("v.s").isNotNull()
    found = df.select(F.explode(F.array(*values)).alias("v")).filter(known).select("v.*").distinct()
    order = ["of", "n", "x", "s"]
    placed = found.repartitionByRange(*order).sortWithinPartitions(*order)
    # The range borders come from a sample; the checkpoint pins them.
    placed = placed.withColumn("__place", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumns({"__range": F.shiftright("__place", 33), "__at": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))})
    # One row per range and column.
    sizes = placed.groupBy("__range", "of").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))
    before = Window.partitionBy("of").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", "of", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__start"))
    coded = placed.join(starts, ["__range", "of"]).withColumn("__code", F.col("__start") + F.col("__at"))
    coded = coded.select(*order, "__code").checkpoint()
    size = F.coalesce(F.octet_length("s"), F.lit(0)).cast("long") + 32
    sizes = {r["of"]: (r["n"], r["size"]) for r in coded.groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size")).collect()}
    out = df
    for i, field in enumerate(fields):
        own = coded.filter(F.col("of") == i).select(*[F.col(c).alias(f"__{c}") for c in "nxs"], F.col("__code").alias(f"{field.name}{suffix}"))
        kind = _kind(field)
        own = F.broadcast(own) if fits_broadcast(*sizes.get(i, (0, 0))) else own
        key = _sorting(field)["nxs".index(kind)]
        out = out.join(own.drop(*[f"__{c}" for c in "nxs" if c != kind]), key == F.col(f"__{kind}"), "left").drop(f"__{kind}")
    codes = [F.coalesce(F.col(f"`{c}{suffix}`"), F.lit(NULL_CODE)).cast("long").alias(f"{c}{suffix}") for c in columns]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *codes)
