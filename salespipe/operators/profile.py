"""Table profiles: aggregates over only the columns they need."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.functions.scalars import null_flag


def null_count(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """One row: how many NULLs the column holds; NULL for an empty table."""
    return df.agg(F.sum(null_flag(column)).alias(alias or f"{column}_NULL"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column; each column is read once."""

    def job(names: list) -> DataFrame:
        counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
        return counted.unpivot([], [F.col(f"`{c}`") for c in names], "column_name", "nulls")

    return _in_groups(df.columns, 90, job)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, fill: float | None = 0) -> DataFrame:
    """Pearson correlations of the numeric columns as (x, y, r).

    NULLs become ``fill`` first; with ``fill=None`` a pair skips the rows where
    either is NULL. A constant column gives NULL.
    """
    names = columns or numeric_columns(df)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    if fill is None:
        halves = _pairwise_correlations(values, pairs)
    else:
        halves = _centred_correlations(values.na.fill(float(fill)), names)
    mirrored = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y", "r"))).otherwise(
        F.array(F.struct("x", "y", "r"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    )
    return halves.select(F.explode(mirrored).alias("cell")).select("cell.*")


def _in_groups(pairs: list, size: int, job: Callable[[list], DataFrame]) -> DataFrame:
    """Spread many aggregates over several passes.

    Spark compiles an aggregate of up to 100 buffer fields to code and
    interprets a wider one, which costs far more than the extra scans.
    """
    jobs = [job(pairs[i : i + size]) for i in range(0, len(pairs), size)]
    return reduce(DataFrame.unionByName, jobs)


def _centred_correlations(values: DataFrame, names: list[str]) -> DataFrame:
    """Means first (three numbers per column come to the driver), then the sums
    of products of the centred columns; that order of work loses no digits.

    Two passes for any number of columns: a task multiplies its batches as
    matrices and gives one row for each pair.
    """
    found = values.agg(
        *[F.avg(f"`{c}`").alias(f"m_{i}") for i, c in enumerate(names)],
        *[F.min(f"`{c}`").alias(f"a_{i}") for i, c in enumerate(names)],
        *[F.max(f"`{c}`").alias(f"b_{i}") for i, c in enumerate(names)],
    ).first()
    # Constant: its spread is nothing, not the rounding error of its mean.
    varies = [i for i in range(len(names)) if found[f"a_{i}"] != found[f"b_{i}"]]
    means = np.array([found[f"m_{i}"] for i in varies], float)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(varies), len(varies)))
        for batch in batches:
            x = np.array([np.asarray(c) for c in batch.columns]).reshape(len(varies), -1) - means[:, None]
            total += x @ x.T
        i, j = np.triu_indices(len(varies))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "s"])

    pairs = [(x, y) for k, x in enumerate(names) for y in names[k:]]
    at = {names[i]: k for k, i in enumerate(varies)}
    listed = values.sparkSession.createDataFrame([(x, y, at.get(x), at.get(y)) for x, y in pairs], "x string, y string, i long, j long")
    if not varies:
        return listed.select("x", "y", F.lit(None).cast("double").alias("r"))
    columns = values.select(*[F.col(f"`{names[i]}`") for i in varies])
    sums = columns.mapInArrow(products, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    # One row per column; the number of columns bounds every side of these joins.
    own = F.map_from_entries(F.collect_list(F.when(F.col("i") == F.col("j"), F.struct("i", F.sqrt("s")))))
    spread = F.broadcast(sums.filter("i = j").agg(own.alias("spread")))
    r = F.try_divide(F.col("s"), F.col("spread")[F.col("i")] * F.col("spread")[F.col("j")])
    return listed.join(sums, ["i", "j"], "left").join(spread, F.lit(True), "left").select("x", "y", r.alias("r"))


def _pairwise_correlations(values: DataFrame, pairs: list) -> DataFrame:
    """Of the rows where both columns of a pair are known, for all pairs in two passes.

    The means first, as above; then a task multiplies its batches with NULLs as 0, and with
    the masks of what is known: that gives the sums of every pair over its own rows, one row a pair and task.
    """
    names = list(dict.fromkeys(x for pair in pairs for x in pair))
    found = values.agg(*[F.avg(f"`{c}`").alias(f"m_{i}") for i, c in enumerate(names)]).first()
    means = np.array([found[f"m_{i}"] if found[f"m_{i}"] is not None else 0.0 for i in range(len(names))])
    cells = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    ends = ["low_x", "high_x", "low_y", "high_y"]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(names)
        sums = {c: np.zeros((p, p)) for c in cells}
        low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
        for batch in batches:
            known = np.array([~np.asarray(c.is_null()) for c in batch.columns]).reshape(p, -1)
            x = np.array([np.asarray(c.fill_null(0.0)) for c in batch.columns]).reshape(p, -1)
            x = np.where(known, x - means[:, None], 0.0)
            mask = known.astype(float)
            sums["n"] += mask @ mask.T
            sums["sx"] += x @ mask.T
            sums["sxx"] += (x * x) @ mask.T
            sums["sxy"] += x @ x.T
            for j in range(p):
                # The range of each column where column j is known: a column is constant by it, not by rounding.
                both = known & known[j]
                low[:, j] = np.minimum(low[:, j], np.where(both, x, np.inf).min(axis=1, initial=np.inf))
                high[:, j] = np.maximum(high[:, j], np.where(both, x, -np.inf).max(axis=1, initial=-np.inf))
        i, j = np.triu_indices(p)
        sums["sy"], sums["syy"] = sums["sx"].T, sums["sxx"].T
        columns = [i, j, *(sums[c][i, j] for c in cells), low[i, j], high[i, j], low[j, i], high[j, i]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", *cells, *ends])

    schema = "i long, j long, " + ", ".join(f"{c} double" for c in cells + ends)
    merged = values.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(products, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in cells], *[(F.min if c.startswith("low") else F.max)(c).alias(c) for c in ends]
    )
    varies = (F.col("low_x") < F.col("high_x")) & (F.col("low_y") < F.col("high_y"))
    covar = F.expr("sxy - sx * sy / n")
    spread = F.sqrt(F.expr("sxx - sx * sx / n")) * F.sqrt(F.expr("syy - sy * sy / n"))
    # A column's product with itself is its own spread, so its correlation is 1 whatever the rounding.
    r = F.when(varies, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.try_divide(covar, spread)))
    listed = values.sparkSession.createDataFrame(
        [(x, y, names.index(x), names.index(y)) for x, y in pairs], "x string, y string, i long, j long"
    )
    return listed.join(merged, ["i", "j"], "left").select("x", "y", r.alias("r"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def monthly(df: DataFrame, when: str, *aggregates: Column) -> DataFrame:
    """Aggregates per calendar month, labelled with the month's first and last day."""
    start = F.date_trunc("month", F.col(when)).cast("date")
    grouped = df.groupBy(start.alias("month_start")).agg(*aggregates)
    return grouped.withColumn("month_end", F.last_day("month_start"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row of (n, mae, mse, r2), from one aggregate; r2 is NULL for a constant label."""
    y, e = F.col(label).cast("double"), (F.col(label) - F.col(prediction)).cast("double")
    sums = df.select(y.alias("y"), e.alias("e")).agg(
        F.count("e").alias("n"),
        F.avg(F.abs("e")).alias("mae"),
        F.avg(F.col("e") * F.col("e")).alias("mse"),
        F.var_pop("y").alias("spread"),
    )
    return sums.select("n", "mae", "mse", (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"))
