"""Equi-joins of a fact table or stream with dimension tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def join_lookup(
    facts: DataFrame, dimension: DataFrame, keys: str | list[str], salt: int = 1, salt_by: str | list[str] = ()
) -> DataFrame:
    """Inner join on equally named keys; the keys appear once, unmatched facts drop out.

    No broadcast hint is given: Spark broadcasts a dimension whose measured size
    is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
    where adaptive execution splits a hot key. ``salt`` > 1 splits every key
    over that many tasks for sessions that run without adaptive execution; the
    dimension is then repeated ``salt`` times. Rows are dealt by a hash of
    ``salt_by``, columns that are unique among the facts: a task that runs
    again deals them as before.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if salt <= 1:
        return facts.join(dimension, keys)
    unique = [salt_by] if isinstance(salt_by, str) else list(salt_by)
    if not unique:
        raise ValueError("salt needs salt_by, columns that are unique among the facts")
    dealt = facts.withColumn(_SALT, F.pmod(F.xxhash64(*unique), F.lit(salt)).cast("int"))
    repeated = dimension.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return dealt.join(repeated, [*keys, _SALT]).drop(_SALT)


def enrich(facts: DataFrame, *lookups: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """Chain ``join_lookup`` over (dimension, keys) pairs; ``facts`` may be a stream."""
    return reduce(lambda df, lookup: join_lookup(df, *lookup), lookups, facts)
