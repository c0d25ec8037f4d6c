"""Keep the newest row or rows of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_BEST = "__best"


def latest_per_key(
    df: DataFrame,
    keys: str | list[str],
    order_by: str,
    *,
    ties: str = "all",
    tie_break: str | list[str] = (),
    few_ties: bool = False,
) -> DataFrame:
    """Rows with the greatest ``order_by`` of their key.

    ``ties="one"`` keeps one row per key, the greatest by ``tie_break``: a
    window whose filter Spark applies inside every map task already, so a key
    that holds a third of the table sends one row per task through the shuffle.

    ``ties="all"`` keeps every row that shares the greatest value, see
    ``latest_by_maximum``. With ``few_ties`` it is a window too, one pass
    over the table; all the tied rows of a key then meet in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    breaks = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    if ties not in ("all", "one"):
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    if ties == "one" and not breaks:
        raise ValueError("ties='one' needs a tie_break column, or the kept row is a matter of chance")
    if ties == "all" and not few_ties:
        return latest_by_maximum(df, keys, order_by)
    order = [F.desc(c) for c in ([order_by, *breaks] if ties == "one" else [order_by])]
    window = Window.partitionBy(*keys).orderBy(*order)
    number = F.row_number() if ties == "one" else F.rank()
    # The filter must follow the window directly to be applied before the shuffle.
    return df.withColumn(_RANK, number.over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by_maximum(df: DataFrame, keys: str | list[str], order_by: str) -> DataFrame:
    """All rows that share the greatest ``order_by`` of their key, however many.

    The greatest value per key is a partial aggregate of two columns; the rows
    are then picked by a semi join on (key, value). While the keys are few
    that join is broadcast and the rows are not shuffled; else adaptive
    execution splits the tied rows of a hot key over many tasks.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    best = df.groupBy(*keys).agg(F.max(order_by).alias(_BEST))
    best = best.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], _BEST)
    match = F.col(order_by).eqNullSafe(F.col(_BEST))
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(best, match, "left_semi")
