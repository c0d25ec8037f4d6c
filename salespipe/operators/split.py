"""Random but repeatable splits of a table."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespipe.functions.scalars import hash_percent

DIGITS = 4  # hexadecimal digits a pass decides: it counts 65,536 values at most


def in_first_part(*keys: Column | str, percent: int = 75) -> Column:
    """True for about ``percent`` % of the keys, always the same ones."""
    return hash_percent(*keys) < percent


def hash_split(df: DataFrame, *keys: Column | str, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: no shuffle, no seed, stable under retries."""
    first = in_first_part(*keys, percent=percent)
    return df.filter(first), df.filter(~first)


def exact_split(
    df: DataFrame, *keys: Column | str, share: float | str | Fraction = "0.25", seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ceil(``share`` of the rows) in test: those with the least hashes of seed and key.

    The hash that parts them is found by counting, four digits of it a pass, so
    nothing is sorted and no row moves. A key that is parted itself
    goes by a hash of the whole row, and equal rows by their number. NULL in a key is a value of its own.
    """
    share = Fraction(str(share))
    if not 0 <= share <= 1:
        raise ValueError(f"share must be between 0 and 1, not {share}")
    named = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("\0")) for k in keys]
    by_key = F.md5(F.concat_ws("|", F.lit(str(seed)), *named).cast("binary"))
    counts = _counts(df, by_key, "")
    k = -(-sum(counts.values()) * share.numerator // share.denominator)
    train, test, tied, rest = _parted(df, by_key, k, counts)
    if tied is not None:
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        by_row = F.md5(F.concat(F.lit(f"{seed}|"), whole).cast("binary"))
        more, fewer, equal, rest = _parted(tied, by_row, rest, _counts(tied, by_row, ""))
        train, test = train.union(more), test.union(fewer)
        if equal is not None:
            # Rows alike in every column: so many of them on either side.
            one = equal.groupBy().agg(F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"), F.count(F.lit(1)).alias("n"))
            copies = lambda n: one.where(f"{n} > 0").select("row", F.explode(F.expr(f"sequence(1L, {n})"))).select("row.*")
            train, test = train.union(copies(f"(n - {rest})")), test.union(copies(f"{rest}L"))
    return train, test


def _counts(df: DataFrame, digest: Column, prefix: str) -> dict[str, int]:
    """Rows by the digits of their hash that follow the prefix."""
    following = F.substring(digest, len(prefix) + 1, DIGITS)
    counted = df.filter(digest.startswith(prefix)).groupBy(following.alias("digits")).agg(F.count(F.lit(1)).alias("n"))
    return {r["digits"]: r["n"] for r in counted.collect()}


def _parted(
    df: DataFrame, digest: Column, k: int, counts: dict[str, int]
) -> tuple[DataFrame, DataFrame, DataFrame | None, int]:
    """(the others, rows of the k least hashes, rows of a hash of which only some belong, how many of them)."""
    prefix = ""
    while True:
        for digits, n in sorted(counts.items()):
            if k <= n:
                break
            k -= n
        else:
            return df.limit(0), df, None, 0
        prefix += digits
        if k in (0, n) or len(prefix) == 32:
            break
        counts = _counts(df, digest, prefix)
    start = F.substring(digest, 1, len(prefix))
    if k == n:
        return df.filter(start > prefix), df.filter(start <= prefix), None, 0
    if k == 0:
        return df.filter(start >= prefix), df.filter(start < prefix), None, 0
    return df.filter(start > prefix), df.filter(start < prefix), df.filter(start == prefix), k
