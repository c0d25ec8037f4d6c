"""Bring a table to a declared schema: column order, names and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAST_POLICIES = ("strict", "null")


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def cast_column(c: Column, to: T.DataType, cast: str = "strict") -> Column:
    """``strict`` raises on a value that cannot be cast, ``null`` gives NULL for it."""
    if cast == "null":
        return c.try_cast(to)
    if cast != "strict":
        raise ValueError(f"cast must be one of {CAST_POLICIES}, not {cast!r}")
    # The check is written out, so that a session with ANSI mode off raises as well.
    bad = c.isNotNull() & c.try_cast(to).isNull()
    message = F.concat(F.lit(f"cannot cast to {to.simpleString()}: "), c.cast("string"))
    return F.when(bad, F.raise_error(message).cast(to)).otherwise(c.try_cast(to))


def conform(
    df: DataFrame, schema: T.StructType | str, *, cast: str = "strict", missing: str = "error"
) -> DataFrame:
    """Select the schema's columns in its order, cast to its types.

    A column the table lacks raises (``missing="error"``) or is filled with
    NULL (``missing="null"``); columns the schema does not name are left out.
    """
    target = as_struct(schema)
    have = {f.name: f.dataType for f in df.schema}
    absent = [f.name for f in target if f.name not in have]
    if absent and missing == "error":
        raise ValueError(f"columns missing from the table: {absent}")
    columns = []
    for field in target:
        if field.name not in have:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have[field.name] == field.dataType:
            columns.append(F.col(f"`{field.name}`"))
        else:
            source = F.col(f"`{field.name}`")
            columns.append(cast_column(source, field.dataType, cast).alias(field.name))
    return df.select(*columns)


def schema_differences(have: T.StructType, want: T.StructType) -> list[str]:
    """What keeps rows of schema ``have`` from being appended to a table of schema ``want``."""
    got = {f.name: f.dataType for f in have}
    wanted = {f.name: f.dataType for f in want}
    found = [f"missing column {n}" for n in wanted if n not in got]
    found += [f"new column {n}" for n in got if n not in wanted]
    found += [
        f"column {n} is {got[n].simpleString()}, not {wanted[n].simpleString()}"
        for n in wanted
        if n in got and got[n] != wanted[n]
    ]
    return found
