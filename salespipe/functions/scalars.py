"""Column expressions with the same answer whether ANSI mode is on or off."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """a / b as a double; NULL when b is zero or either side is NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def truncate_to_int(c: Column | str, to: str = "int") -> Column:
    """Cut the fraction off toward zero; NULL when the value does not fit."""
    return coerce(c, to)


def coerce(c: Column | str, to: str | T.DataType) -> Column:
    """Cast, with NULL for what cannot be cast."""
    return _col(c).try_cast(to)


def coerce_number(c: Column | str) -> Column:
    return coerce(c, "double")


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def sanitize_name(c: Column | str) -> Column:
    """Each run of characters that are not letters, digits or `_` becomes one `_`."""
    return F.regexp_replace(_col(c), r"\W+", "_")


def null_flag(c: Column | str) -> Column:
    """1 for NULL and 0 otherwise."""
    return F.when(_col(c).isNull(), 1).otherwise(0)


def day_label(day: dt.date | None = None) -> Column:
    """`yyyy-MM-dd` of the given day, or of the query's current date."""
    return F.date_format(F.lit(day) if day is not None else F.current_date(), "yyyy-MM-dd")


def month_key(c: Column | str) -> Column:
    """`yyyy-MM`, the folder key of monthly outputs."""
    return F.date_format(_col(c), "yyyy-MM")


def hash_percent(*keys: Column | str) -> Column:
    """A stable number 0..99 for a key: the same in every partitioning and engine."""
    text = F.concat_ws("|", *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int") % 100
