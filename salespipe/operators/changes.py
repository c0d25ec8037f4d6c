"""Row changes as functions from tables to tables: upsert, delete, update, diff.

Nothing here writes; ``salespipe.tables.versioned`` stores the results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.functions.conform import cast_column, conform
from salespipe.operators.sizing import BROADCAST_LIMIT, fits_broadcast, row_bytes
from salespipe.session import ensure_checkpoint_dir

CHANGE = "_change"
COPIES = "_copies"


class AmbiguousMerge(ValueError):
    """Several source rows match one target row."""


class NullKey(ValueError):
    """A column declared NOT NULL holds a NULL."""


def _expr(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _keys_set(keys: list[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"`{k}`").isNotNull()
    return condition


# ---------------------------------------------------------------- constraints


def require_not_null(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """The same rows; the job fails with a message at the first NULL in ``columns``."""
    checked = df
    for name in [columns] if isinstance(columns, str) else columns:
        c = F.col(f"`{name}`")
        kind = df.schema[name].dataType
        stop = F.raise_error(F.lit(f"NOT NULL constraint failed: {name}")).cast(kind)
        checked = checked.withColumn(name, F.when(c.isNull(), stop).otherwise(c))
    return checked


# --------------------------------------------------------------------- upsert


@dataclass(frozen=True)
class SourceFacts:
    """What one aggregate over the source tells: its size and its busiest key."""

    rows: int
    size: int
    most_per_key: int
    buckets: frozenset[int] = frozenset()


def inspect_source(source: DataFrame, keys: list[str], bucket: Column | None = None) -> SourceFacts:
    """``bucket``, a function of the keys with few values, is gathered along the way."""
    per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(source.schema)).alias("size")
    )
    found = per_key.agg(
        F.collect_set(bucket if bucket is not None else F.lit(None).cast("int")).alias("buckets"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        # NULL keys match nothing, so any number of them is unambiguous.
        F.coalesce(F.max(F.when(_keys_set(keys), F.col("n"))), F.lit(0)).alias("most"),
    ).first()
    return SourceFacts(found["rows"], found["size"], found["most"], frozenset(found["buckets"]))


def _reject_ambiguous(target: DataFrame, source: DataFrame, keys: list[str]) -> None:
    repeated = source.filter(_keys_set(keys)).groupBy(*keys).count().filter("count > 1").drop("count")
    hit = repeated.join(target.select(*keys), keys, "left_semi").first()
    if hit is not None:
        raise AmbiguousMerge(f"several source rows match the target rows of key {hit.asDict()}")


def align_source(target: T.StructType, source: DataFrame, missing: str = "error", cast: str = "strict") -> DataFrame:
    """The source's share of the target's columns, in the target's types."""
    absent = [c for c in target.fieldNames() if c not in source.columns]
    if missing not in ("error", "keep"):
        raise ValueError(f"missing must be 'error' or 'keep', not {missing!r}")
    if absent and missing == "error":
        raise ValueError(f"the source lacks columns of the target: {absent}")
    shared = T.StructType([f for f in target if f.name in source.columns])
    return conform(source, shared, cast=cast)


def may_broadcast(facts: SourceFacts, options: dict) -> bool:
    """Whether ``merge_parts`` with these options broadcasts such a source."""
    return fits_broadcast(facts.rows, facts.size, options.get("broadcast_limit", BROADCAST_LIMIT))


@dataclass(frozen=True)
class MergeParts:
    """The two halves of an upsert result, and how the source was joined."""

    kept: DataFrame
    inserted: DataFrame
    source_broadcast: bool


def merge_parts(
    target: DataFrame,
    source: DataFrame,
    keys: str | list[str],
    *,
    on_match: str = "replace",
    newer_by: str | list[str] = (),
    missing: str = "error",
    cast: str = "strict",
    broadcast_limit: int = BROADCAST_LIMIT,
    facts: SourceFacts | None = None,
    images: bool = False,
) -> MergeParts:
    """Compute an upsert as (target rows with replacements, source rows without a match).

    Target rows are kept or replaced by a left join from the target, so
    duplicates of a key stay duplicates. A source within ``broadcast_limit``
    (as a relation, measured by the same aggregate that looks for repeated keys) is broadcast
    and the target is not shuffled at all; a larger one is shuffle-joined, and
    as a left join that plan lets adaptive execution split a hot target key,
    which it cannot do for a full outer join.

    ``images``: both halves show their changes as well, see ``with_images``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newer = [newer_by] if isinstance(newer_by, str) else list(newer_by)
    if on_match not in ("replace", "if_newer"):
        raise ValueError(f"on_match must be 'replace' or 'if_newer', not {on_match!r}")
    if on_match == "if_newer" and not newer:
        raise ValueError("on_match='if_newer' needs newer_by columns")

    rows = align_source(target.schema, source, missing, cast)
    facts = facts or inspect_source(rows, keys)
    if facts.most_per_key > 1:
        _reject_ambiguous(target, rows, keys)
    small = fits_broadcast(facts.rows, facts.size, broadcast_limit)

    incoming = rows.filter(_keys_set(keys)).select(
        *[F.col(f"`{c}`").alias(f"__s_{c}") for c in rows.columns], F.lit(True).alias("__s")
    )
    if facts.most_per_key > 1:
        # Repeated keys that match no target row are plain inserts.
        incoming = incoming.dropDuplicates([f"__s_{k}" for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"`{k}`") == F.col(f"`__s_{k}`"))
    if small:
        joined = target.join(F.broadcast(incoming), on, "left")
    else:
        # A source that is already distributed by its keys would be joined as it
        # lies, and adaptive execution splits hot keys only where both sides are
        # shuffled for the join. The hash in the condition makes it shuffle both.
        on = on & (F.xxhash64(*keys) == F.xxhash64(*[f"__s_{k}" for k in keys]))
        joined = target.join(incoming, on, "left")

    use = F.col("__s").isNotNull()
    if on_match == "if_newer":
        theirs = F.struct(*[F.col(f"`__s_{c}`").alias(c) for c in newer])
        ours = F.struct(*[F.col(f"`{c}`").alias(c) for c in newer])
        use = use & (theirs > ours)
    after = [
        F.when(use, F.col(f"`__s_{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
        if c in rows.columns and c not in keys
        else F.col(f"`{c}`")
        for c in target.columns
    ]
    kept = with_images(joined, target.columns, use, after) if images else joined.select(*after)

    known = target.select(*keys).filter(_keys_set(keys))
    if small:
        known = known.join(F.broadcast(rows.select(*keys)), keys, "left_semi").distinct()
        # No more keys than the source has, so bounded by the same measure.
        unmatched = rows.join(F.broadcast(known), keys, "left_anti")
    else:
        # NULL keys match nothing; left out of the join, they do not all meet in one task.
        unmatched = rows.filter(_keys_set(keys)).join(known.distinct(), keys, "left_anti")
        unmatched = unmatched.unionByName(rows.filter(~_keys_set(keys)))
    inserted = conform(unmatched, target.schema, missing="null")
    if images:
        whole = F.struct(*[F.col(f"`{c}`") for c in target.columns])
        inserted = _imaged(inserted, target.columns, F.array(_image(DATA, whole), _image("insert", whole)))
    return MergeParts(kept, inserted, small)


def upsert(target: DataFrame, source: DataFrame, keys: str | list[str], **options) -> DataFrame:
    """The target after an upsert by key; see ``merge_parts`` for the options.

    ``on_match="replace"``: a matching source row replaces the target row.
    ``on_match="if_newer"``: only when its ``newer_by`` columns compare greater,
    which makes the result independent of how rows fell into batches.
    ``missing="keep"``: a target column the source lacks keeps its value, and is
    NULL in inserted rows. Source columns the target lacks are left out.

    The source is measured, joined and searched for new keys, so it is computed
    once and kept by a checkpoint. Of the target, the second look reads the keys only.
    """
    ensure_checkpoint_dir(source.sparkSession)
    parts = merge_parts(target, source.checkpoint(), keys, **options)
    return parts.kept.unionByName(parts.inserted)


# ------------------------------------------------------------- delete, update


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows for which the condition is not true; NULL conditions keep the row."""
    return df.filter(~F.coalesce(_expr(condition), F.lit(False)))


def update_where(df: DataFrame, values: dict[str, object], condition: Column | str) -> DataFrame:
    """Set columns to constants or expressions of the old row where the condition is true."""
    return df.select(*_updated(df, values, condition))


def _updated(df: DataFrame, values: dict[str, object], condition: Column | str) -> list[Column]:
    chosen = _expr(condition)
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if field.name in values:
            new = values[field.name]
            new = new if isinstance(new, Column) else F.lit(new)
            c = F.when(chosen, cast_column(new, field.dataType)).otherwise(c).alias(field.name)
        columns.append(c)
    unknown = set(values) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return columns


# -------------------------------------------------------------- change images

KIND = "change_kind"
DATA = "data"  # the kind of rows that are the table's own


def _image(kind: str, row: Column) -> Column:
    return F.struct(F.lit(kind).alias(KIND), row.alias("row"))


def _imaged(df: DataFrame, names: list[str], images: Column) -> DataFrame:
    shown = df.select(F.explode(images).alias("image"))
    return shown.select(*[F.col("image.row")[c].alias(c) for c in names], f"image.{KIND}")


def with_images(df: DataFrame, names: list[str], changed: Column, after: list[Column]) -> DataFrame:
    """The new rows (kind ``data``) and, of changed ones, the old and the new row once more.

    The table's rows and what changed in them come out of one pass, to be written side by side.
    """
    old, new = F.struct(*[F.col(f"`{c}`") for c in names]), F.struct(*[c.alias(n) for c, n in zip(after, names, strict=True)])
    both = F.array(_image(DATA, new), _image("update_preimage", old), _image("update_postimage", new))
    return _imaged(df, names, F.when(changed, both).otherwise(F.array(_image(DATA, new))))


def delete_with_images(df: DataFrame, condition: Column | str) -> DataFrame:
    """All rows: those that stay as kind ``data``, the others as kind ``delete``."""
    gone = F.coalesce(_expr(condition), F.lit(False))
    return df.withColumn(KIND, F.when(gone, F.lit("delete")).otherwise(F.lit(DATA)))


def update_with_images(df: DataFrame, values: dict[str, object], condition: Column | str) -> DataFrame:
    """As ``update_where``, with the old and new image of every row the condition holds for."""
    after = _updated(df, values, condition)
    return with_images(df, df.columns, F.coalesce(_expr(condition), F.lit(False)), after)


# ---------------------------------------------------------------- change feed


def _same_columns(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the columns of either; absent ones NULL."""
    names = [*before.columns, *[c for c in after.columns if c not in before.columns]]
    kinds = {f.name: f.dataType for f in [*before.schema, *after.schema]}
    target = T.StructType([T.StructField(n, kinds[n]) for n in names])
    return conform(before, target, missing="null"), conform(after, target, missing="null")


def change_feed(before: DataFrame, after: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows that differ between two states with a unique key.

    ``_change`` is insert, update or delete; a deleted row shows its old
    values, an updated row its new ones. Columns compare NULL-safe. Rows with a
    NULL key match nothing: they are deletes and inserts, and stay out of the
    joins, where they would all meet in one task. A key that repeats fails the
    job; such tables need ``row_difference``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    old, new = _same_columns(before, after)
    names = old.columns
    was, now = _one_per_key(old, keys, "__o"), _one_per_key(new, keys, "__n")
    differs = F.lit(False)
    for c in names:
        if c not in keys:
            differs = differs | ~F.col(f"__o.`{c}`").eqNullSafe(F.col(f"__n.`{c}`"))
    change = F.when(F.col("__o").isNull(), "insert").when(differs, "update")
    # Both sides are already distributed by key, one row each.
    here = now.join(was, keys, "left").withColumn(CHANGE, change).filter(F.col(CHANGE).isNotNull())
    gone = was.join(now.select(*keys), keys, "left_anti")
    return (
        here.select("__n.*", CHANGE)
        .unionByName(gone.select("__o.*", F.lit("delete").alias(CHANGE)))
        .unionByName(new.filter(~_keys_set(keys)).withColumn(CHANGE, F.lit("insert")))
        .unionByName(old.filter(~_keys_set(keys)).withColumn(CHANGE, F.lit("delete")))
    )


def _one_per_key(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys and the whole row as a struct; the job fails where a key has several rows."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    found = df.filter(_keys_set(keys)).groupBy(*keys).agg(F.first(row).alias(name), F.count(F.lit(1)).alias("__copies"))
    stop = F.raise_error(F.concat(F.lit(f"repeated key {keys}: "), F.to_json(F.struct(*keys)))).cast(found.schema[name].dataType)
    return found.select(*keys, F.when(F.col("__copies") > 1, stop).otherwise(F.col(name)).alias(name))


def row_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows gained and lost between two states without a unique key.

    Equal rows are counted on both sides in one partial aggregate; ``_copies``
    says how many of a row came or went, so a row repeated a billion times
    stays one output row.
    """
    old, new = _same_columns(before, after)
    names = old.columns
    tagged = old.withColumn("__n", F.lit(-1).cast("long")).unionByName(new.withColumn("__n", F.lit(1).cast("long")))
    net = tagged.groupBy(*names).agg(F.sum("__n").alias("__n")).filter("__n <> 0")
    return net.select(
        *names,
        F.when(F.col("__n") > 0, "insert").otherwise("delete").alias(CHANGE),
        F.abs("__n").alias(COPIES),
    )
