"""Rows whose features fall into the same bins, as one weighted row: all that trees for squared error need of them.

Trees part rows only at thresholds between bins, so rows of one cell are never
parted. The number of a cell's rows, the mean of their labels and the
sum of the squares around it give the same counts, sums and squared errors of every node and
leaf as the rows one by one. A fit reads the rows twice, once for the bins and
once for the cells; each round goes over the cells, of which there are at most
``bins`` to the power of the number of features, however many rows there are.

A feature's bins lie around values of its own: its quantiles over all rows, or all its
values where they are few. A row belongs to the nearest, and the thresholds are the midpoints, which are
those Spark's trees choose from when they are given these values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS, KNOWN, MEAN, SPREAD, UNKNOWN = "__rows", "__known", "__mean", "__spread", "__unknown"
SUMMARY = [ROWS, KNOWN, MEAN, SPREAD]
PRECISION = 20  # times as exact as the bins are wide


def quantiles(feature: str, bins: int, where: Column) -> Column:
    """The values that a feature's bins lie around, as an aggregate."""
    shares = [i / (bins - 1) for i in range(bins)] if bins > 1 else [0.5]
    return F.percentile_approx(F.when(where, F.col(f"`{feature}`")), shares, bins * PRECISION)


def _binned(feature: str, values: list[float] | None) -> Column:
    """The value whose bin a row is in; NULL and NaN stay."""
    own = F.col(f"`{feature}`")
    values = sorted({v + 0.0 for v in values or [] if not math.isnan(v)})
    if not values:
        return own
    borders = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]

    def place(first: int, last: int) -> Column:
        # As a tree of comparisons; a value at a border is left of it.
        if first == last:
            return F.lit(values[first])
        mid = (first + last) // 2
        return F.when(own <= borders[mid], place(first, mid)).otherwise(place(mid + 1, last))

    return F.when(own.isNull() | F.isnan(own), own).otherwise(place(0, len(values) - 1))


def cells(df: DataFrame, values: dict[str, list[float]], label: str, *by: str) -> DataFrame:
    """One row per cell and ``by``: features, rows, rows whose label is known, their mean, and the sum of the squares around it.

    Rows without a label are apart.
    """
    binned = df.select(
        *[_binned(f, v).alias(f) for f, v in values.items()], *by, F.col(f"`{label}`").alias(MEAN), F.col(f"`{label}`").isNull().alias(UNKNOWN)
    )
    grouped = binned.groupBy(*[F.col(f"`{f}`") for f in values], *by, UNKNOWN)
    return grouped.agg(
        F.count(F.lit(1)).alias(ROWS), F.count(MEAN).alias(KNOWN), F.avg(MEAN).alias(MEAN), (F.var_pop(MEAN) * F.count(MEAN)).alias(SPREAD)
    ).drop(UNKNOWN)


def bins_of_trees(bins: int, n: int) -> int:
    """The ``maxBins`` by which Spark's trees take every midpoint: they sample no more rows than its square for the thresholds."""
    return max(2, bins, math.isqrt(n) + 1)
