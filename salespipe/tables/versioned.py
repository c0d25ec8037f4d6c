"""A table of which every write is a version, kept as plain parquet folders.

``<root>/data/version=N-<attempt>`` holds the rows that version N added or
rewrote, and ``<root>/commits/N.json`` lists the folders ("parts") that make up
the table at N. The commit file is written last and by rename, so a job that
dies half way leaves no version behind. Every attempt has a folder of its own:
of two writers of one version the second fails, and its rows are in no version.

An append writes its own rows only. Delete, update and upsert rewrite only the
parts that hold rows they touch; with ``buckets`` a version is split by a hash
of the key into ``bucket_id=B`` parts, which is what keeps a small upsert
into a big table small. Without buckets an upsert looks for the parts that hold
its keys first.

A table created with ``change_feed`` records what every write changes. A rewrite
writes its rows and their changes in one pass, side by side in folders by
``change_kind``; an append or overwrite writes nothing twice, as its parts are the
changes. The commit lists the folders of its changes, so the feed of some versions
opens these alone, shows every step between, and needs no key.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.functions.conform import as_struct, conform, schema_differences
from salespipe.operators import changes
from salespipe.sources import storage

BUCKET = "bucket_id"
KIND, DATA = changes.KIND, changes.DATA
DEFAULT_RETENTION_HOURS = 7 * 24

# The parts of a version are left out: together they grow with the square of the commits.
HISTORY_SCHEMA = (
    "version long, committed_at timestamp, operation string, params map<string,string>, rows long, "
    "schema string, query_id string, batch_id long"
)
LOG_SCHEMA = "version long, committed_at timestamp, parts array<struct<path:string>>, feed array<struct<path:string, kind:string>>"
_PART = r"/data/((?:version=[^/]+)(?:/change_kind=[a-z_]+)?(?:/bucket_id=\d+)?)/[^/]+$"
# Up to so many buckets the write itself counts their rows; each takes an aggregate of its own.
COUNTED_BUCKETS = 64


class SchemaMismatch(ValueError):
    """Appended rows do not have the table's schema."""


class VersionNotFound(ValueError):
    """There is no such version, or no version that old."""


class VersionRetired(ValueError):
    """The version's files were vacuumed."""


class NoChangeFeed(ValueError):
    """The table does not record its changes."""


class NotAppended(ValueError):
    """A stream of appended rows came to a version that changed rows."""


@dataclass(frozen=True)
class Commit:
    """One version: what made it and which folders it consists of."""

    version: int
    committed_at: str
    operation: str
    schema: str
    params: dict[str, str] = field(default_factory=dict)
    parts: list[dict] = field(default_factory=list)
    rows: int = 0
    not_null: list[str] = field(default_factory=list)
    bucket_by: list[str] = field(default_factory=list)
    buckets: int = 0
    query_id: str | None = None
    batch_id: int | None = None
    # Whether writes record their changes, and where this one's are.
    change_feed: bool = False
    feed: list[dict] = field(default_factory=list)
    # The last batch of every stream that wrote to the table.
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def paths(self) -> list[str]:
        return [p["path"] for p in self.parts]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _bucket_of(path: str) -> int:
    return int(path.rsplit(f"{BUCKET}=", 1)[1])


def _entries(paths: list[str], kind: str) -> list[dict]:
    """Whole parts as changes of one kind."""
    return [{"path": p, "kind": kind} for p in paths]


def _utc(moment: dt.datetime) -> dt.datetime:
    return moment.astimezone(dt.timezone.utc)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ definition

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        schema: T.StructType | str,
        *,
        not_null: str | list[str] = (),
        bucket_by: str | list[str] = (),
        buckets: int = 0,
        change_feed: bool = False,
        now: dt.datetime | None = None,
    ) -> VersionedTable:
        """Version 0, empty; an existing table is left as it is.

        ``buckets`` is fixed for the table's life: choose it so that a bucket
        of the full-grown table is a few hundred megabytes. ``change_feed``, also
        fixed, records the changes of every write for ``recorded_changes``.
        """
        table = cls(spark, root)
        if table.exists():
            return table
        struct = as_struct(schema)
        keys = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
        if bool(keys) != bool(buckets):
            raise ValueError("bucket_by and buckets go together")
        if {BUCKET, KIND} & set(struct.fieldNames()):
            raise ValueError(f"{BUCKET} and {KIND} are the names of the table's own folders")
        required = [not_null] if isinstance(not_null, str) else list(not_null)
        required = sorted({*required, *[f.name for f in struct if not f.nullable]})
        table._publish(
            Commit(
                version=0,
                committed_at="",
                operation="CREATE TABLE",
                schema=_nullable(struct).json(),
                not_null=required,
                bucket_by=keys,
                buckets=buckets,
                change_feed=change_feed,
            ),
            now,
        )
        return table

    def exists(self) -> bool:
        return self._newest() is not None

    # --------------------------------------------------------------- reading

    def version(self) -> int:
        newest = self._newest()
        if newest is None:
            raise VersionNotFound(f"no table at {self.root}")
        return newest

    def read(self, version: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
        """The current state, the state at a version, or the state at a moment."""
        if version is not None and as_of is not None:
            raise ValueError("give a version or a moment, not both")
        if as_of is not None:
            version = self.version_as_of(as_of)
        commit = self._commit(version)
        if version is not None:
            self._require_parts(commit)
        return self._scan(commit, commit.paths)

    def version_as_of(self, moment: dt.datetime) -> int:
        """The newest version committed at or before a moment."""
        at = F.lit(_utc(moment))
        found = self.history().filter(F.col("committed_at") <= at).agg(F.max("version")).first()[0]
        if found is None:
            raise VersionNotFound(f"no version at or before {moment}")
        return found

    def history(self) -> DataFrame:
        """One row per version: what made it, when, and how many rows it has."""
        return self.spark.read.schema(HISTORY_SCHEMA).json(f"{self.root}/commits")

    def changes(self, before: int, after: int, keys: str | list[str] | None = None) -> DataFrame:
        """What changed between two versions; reads only the parts they do not share.

        With unique ``keys``: insert, update and delete rows. Without: whole
        rows gained and lost, with their number of copies.
        """
        old, new = self._commit(before), self._commit(after)
        self._require_parts(old)
        self._require_parts(new)
        shared = set(old.paths) & set(new.paths)
        was = self._scan(old, [p for p in old.paths if p not in shared])
        now = self._scan(new, [p for p in new.paths if p not in shared])
        return changes.change_feed(was, now, keys) if keys else changes.row_difference(was, now)

    def recorded_changes(self, first: int, last: int | None = None) -> DataFrame:
        """What versions ``first`` to ``last`` (default: the newest) changed, row by row as their writes recorded it.

        Adds ``_change`` (insert, delete, update_preimage, update_postimage), ``_version`` and
        ``_committed_at`` to the columns of the last version. Reads the folders of changes only.
        """
        head = self._commit(last)
        if not head.change_feed:
            raise NoChangeFeed(f"the table at {self.root} was created without change_feed")
        found = self._log().filter(F.col("version").between(first, head.version))
        entries = found.select("version", "committed_at", F.explode("feed").alias("f")).select(
            F.col("f.path").alias("__part"), F.col("f.kind").alias("_change"),
            F.col("version").alias("_version"), F.col("committed_at").alias("_committed_at"),
        )
        paths = sorted(r[0] for r in entries.select("__part").distinct().collect())
        self._require(paths, f"changes of versions {first} to {head.version}")
        rows = self._scan(head, paths, *([self._part()] if paths else [F.lit("").alias("__part")]))
        return rows.join(entries, "__part").drop("__part")

    def across(self, versions: list[int], **measures: Column) -> DataFrame:
        """(version, rows, and the sum of each measure, a number for every row) of several versions.

        Every part is scanned once and added up for all the versions that hold it.
        The sum over a version without rows is NULL.
        """
        newest = self._commit(max(versions))
        wanted = self.spark.createDataFrame([(v,) for v in versions], "version long")
        held = self._log().join(wanted, "version").select("version", F.explode("parts.path").alias("__part"))
        paths = sorted(r[0] for r in held.select("__part").distinct().collect())
        self._require(paths, f"versions {versions}")
        rows = self._scan(newest, paths, *([self._part()] if paths else [F.lit("").alias("__part")]))
        shown = rows.select("__part", *[c.alias(n) for n, c in measures.items()])
        sums = shown.groupBy("__part").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(f"`{n}`").alias(n) for n in measures])
        found = held.join(sums, "__part").groupBy("version").agg(
            F.sum("rows").alias("rows"), *[F.sum(f"`{n}`").alias(n) for n in measures]
        )
        return wanted.join(found, "version", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))

    def appended_by(self, versions: list[int]) -> DataFrame:
        """The rows that these versions appended; a version that rewrote or removed rows raises."""
        commits = [self._commit(v) for v in sorted(versions)]
        parts: list[str] = []
        for commit in commits:
            if commit.operation == "APPEND":
                parts += [p for p in commit.paths if p.startswith(f"version={commit.version}-")]
            elif commit.version and set(commit.paths) != set(self._commit(commit.version - 1).paths):
                raise NotAppended(f"version {commit.version} is no append but {commit.operation}")
        self._require(parts, f"rows appended by versions {versions}")
        return self._scan(commits[-1] if commits else self._commit(), parts)

    # --------------------------------------------------------------- writing

    def overwrite(self, df: DataFrame, *, cast: str = "strict", now: dt.datetime | None = None) -> int:
        """Replace all rows; the schema stays."""
        head = self._commit()
        rows = conform(df, head.struct, cast=cast)
        parts = self._write(head, self._laid_out(head, rows))
        feed = _entries(head.paths, "delete") + _entries([p["path"] for p in parts], "insert")
        return self._publish(self._next(head, "OVERWRITE", parts, feed), now)

    def append(self, df: DataFrame, *, merge_schema: bool = False, now: dt.datetime | None = None) -> int:
        """Add rows. A schema that differs raises, or (``merge_schema``) widens the table.

        With ``merge_schema`` new columns are NULL in the old rows and columns
        the new rows lack are NULL in them; a column that changes type raises.
        """
        head = self._commit()
        have, want = _nullable(df.schema), head.struct
        differences = schema_differences(have, want)
        if merge_schema:
            differences = [d for d in differences if not d.startswith(("missing", "new"))]
        if differences:
            raise SchemaMismatch("; ".join(differences))
        widened = T.StructType([*want.fields, *[f for f in have if f.name not in want.fieldNames()]])
        head = replace(head, schema=widened.json())
        rows = conform(df, widened, missing="null")
        parts = self._write(head, self._laid_out(head, rows))
        feed = _entries([p["path"] for p in parts], "insert")
        commit = self._next(head, "APPEND", head.parts + parts, feed, mergeSchema=str(merge_schema).lower())
        return self._publish(commit, now)

    def delete(self, condition: str | Column, *, now: dt.datetime | None = None) -> int:
        """Remove the rows for which the condition is true."""
        change = changes.delete_with_images if self._commit().change_feed else changes.delete_where
        return self._rewrite("DELETE", condition, lambda rows: change(rows, condition), now)

    def update(self, values: dict[str, object], condition: str | Column, *, now: dt.datetime | None = None) -> int:
        """Set columns where the condition is true."""
        head = self._commit()
        if set(values) & set(head.bucket_by):
            raise ValueError("the columns a table is bucketed by cannot be updated")
        change = changes.update_with_images if head.change_feed else changes.update_where
        return self._rewrite("UPDATE", condition, lambda rows: change(rows, values, condition), now)

    def upsert(
        self,
        source: DataFrame,
        keys: str | list[str],
        *,
        batch: tuple[str, int] | None = None,
        now: dt.datetime | None = None,
        **options,
    ) -> int:
        """Upsert by key, with the options of ``changes.merge_parts``.

        ``batch`` is (stream id, batch id); a batch already committed is left
        out, so a replayed micro-batch has no effect. An empty source makes no
        version.
        """
        head = self._commit()
        if batch is not None and self._has_batch(head, batch):
            return head.version
        keys = [keys] if isinstance(keys, str) else list(keys)
        # Measured, joined and searched for new keys: computed once for all of it.
        aligned = changes.align_source(
            head.struct, source, options.get("missing", "error"), options.get("cast", "strict")
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._merge(head, aligned, keys, batch, now, options)
        finally:
            aligned.unpersist()

    def _merge(self, head: Commit, source: DataFrame, keys: list[str], batch, now, options: dict) -> int:
        by_bucket = head.buckets and set(head.bucket_by) <= set(keys)
        facts = changes.inspect_source(source, keys, self._bucket(head) if by_bucket else None)
        if not facts.rows:
            return head.version
        if by_bucket:
            touched = [p for p in head.paths if _bucket_of(p) in facts.buckets]
        else:
            touched = self._parts_with(head, source, keys, changes.may_broadcast(facts, options))
        halves = changes.merge_parts(
            self._scan(head, touched), source, keys, facts=facts, images=head.change_feed, **options
        )
        if not head.buckets:
            rows = halves.kept.unionByName(halves.inserted)
        elif halves.source_broadcast:
            # The kept half was not shuffled, so its tasks still read whole
            # bucket folders; only the inserted rows must be brought together.
            kept = halves.kept.withColumn(BUCKET, self._bucket(head))
            rows = kept.unionByName(self._laid_out(head, halves.inserted))
        else:
            rows = self._laid_out(head, halves.kept.unionByName(halves.inserted))
        parts, feed = self._write_recorded(head, rows)
        untouched = [p for p in head.parts if p["path"] not in set(touched)]
        commit = self._next(head, "MERGE", untouched + parts, feed, keys=",".join(keys))
        if batch is not None:
            commit = replace(
                commit, query_id=batch[0], batch_id=batch[1], batches={**head.batches, batch[0]: batch[1]}
            )
        return self._publish(commit, now)

    def has_batch(self, batch: tuple[str, int]) -> bool:
        return self._has_batch(self._commit(), batch)

    def vacuum(
        self,
        retain_hours: float = DEFAULT_RETENTION_HOURS,
        *,
        check: bool = True,
        now: dt.datetime | None = None,
    ) -> list[str]:
        """Delete parts that left the table longer ago than the retention; returns them.

        Parts of the current version always stay. A retention under seven days
        raises unless ``check=False``.
        """
        if check and retain_hours < DEFAULT_RETENTION_HOURS:
            raise ValueError(f"retention of {retain_hours} h is below {DEFAULT_RETENTION_HOURS} h; pass check=False")
        now = now or dt.datetime.now(dt.timezone.utc)
        head = self._commit()
        cutoff = _utc(now) - dt.timedelta(hours=retain_hours)
        # Versions in force at the cutoff or later keep their parts; those in
        # force when it came are the newest of the older ones.
        first = self.history().filter(F.col("committed_at") <= F.lit(cutoff)).agg(F.max("version")).first()[0] or 0
        log = self._log().filter(F.col("version").between(first, head.version))
        # What the first of them changed was recorded before the cutoff.
        recorded = log.filter(F.col("version") > first).select(F.explode("feed.path").alias("path"))
        live = log.select(F.explode("parts.path").alias("path")).union(recorded).distinct()
        kept = {r[0] for r in live.collect()}
        gone = []
        for folder in storage.list_names(self.spark, self._data("")):
            # A folder of a version yet to come may be another writer's work.
            if int(folder.removeprefix("version=").split("-")[0]) > head.version:
                continue
            parts = self._parts_in(folder)
            stale = [p for p in parts if p not in kept]
            for path in [folder] if stale == parts else stale:
                storage.delete_folder(self.spark, self._data(path))
            gone += stale
        commit = self._next(head, "VACUUM", head.parts, retainHours=str(retain_hours), removed=str(len(gone)))
        self._publish(commit, now)
        return gone

    # -------------------------------------------------------------- internal

    def _data(self, path: str) -> str:
        return f"{self.root}/data/{path}"

    def _file(self, version: int) -> str:
        return f"{self.root}/commits/{version:020d}.json"

    def _newest(self) -> int | None:
        """The newest version: at or a little after the one noted in the hint.

        The hint spares a listing of all commits, which grow by one with every
        micro-batch. It may lag or be missing, but is never ahead.
        """
        try:
            version = int(storage.read_text(self.spark, self._hint()))
        except Exception:  # noqa: BLE001 - no hint, or half written: list the commits
            names = [n for n in storage.list_names(self.spark, f"{self.root}/commits") if n.endswith(".json")]
            return int(names[-1][: -len(".json")]) if names else None
        while storage.exists(self.spark, self._file(version + 1)):
            version += 1
        return version

    def _hint(self) -> str:
        return f"{self.root}/newest"

    def _commit(self, version: int | None = None) -> Commit:
        if version is None:
            version = self.version()
        elif not storage.exists(self.spark, self._file(version)):
            raise VersionNotFound(f"no version {version} at {self.root}")
        return Commit(**json.loads(storage.read_text(self.spark, self._file(version))))

    def _log(self) -> DataFrame:
        """Versions with the folders of their rows and of their changes."""
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/commits")

    def _parts_in(self, folder: str) -> list[str]:
        """The parts below a folder of one write: by kind of change, by bucket, by both, or the folder itself."""
        names = storage.list_names(self.spark, self._data(folder))
        below = [n for n in names if n.startswith((f"{KIND}=", f"{BUCKET}="))]
        return [p for n in below for p in self._parts_in(f"{folder}/{n}")] or [folder]

    def _require_parts(self, commit: Commit) -> None:
        self._require(commit.paths, f"version {commit.version}")

    def _require(self, paths: list[str], what: str) -> None:
        tops = {p for p in paths if "/" not in p}
        there = {p for p in tops if storage.exists(self.spark, self._data(p))}
        for above in {p.rsplit("/", 1)[0] for p in paths if p not in tops}:
            there |= {f"{above}/{n}" for n in storage.list_names(self.spark, self._data(above))}
        gone = [p for p in paths if p not in there]
        if gone:
            raise VersionRetired(f"{what}: vacuumed, {len(gone)} of the parts are gone")

    @staticmethod
    def _part() -> Column:
        return F.regexp_extract("_metadata.file_path", _PART, 1).alias("__part")

    def _scan(self, commit: Commit, paths: list[str], *more: Column) -> DataFrame:
        columns = [F.col(f"`{f.name}`") for f in commit.struct]
        if not paths:
            return self.spark.createDataFrame([], commit.struct).select(*columns, *more)
        rows = self.spark.read.schema(commit.struct).option("recursiveFileLookup", True)
        return rows.parquet(*[self._data(p) for p in paths]).select(*columns, *more)

    @staticmethod
    def _bucket(commit: Commit) -> Column:
        keys = F.xxhash64(*[F.col(f"`{k}`") for k in commit.bucket_by])
        return F.pmod(keys, F.lit(commit.buckets)).cast("int").alias(BUCKET)

    def _laid_out(self, commit: Commit, df: DataFrame) -> DataFrame:
        """Rows grouped by bucket for few files per folder; a big bucket may be split."""
        if not commit.buckets:
            return df
        by = [F.col(c) for c in (KIND, BUCKET) if c == BUCKET or c in df.columns]
        return df.withColumn(BUCKET, self._bucket(commit)).hint("rebalance", *by)

    def _write(self, head: Commit, rows: DataFrame) -> list[dict]:
        """Write rows that are all the table's own; the parts that hold them."""
        return self._write_recorded(head, rows)[0]

    def _write_recorded(self, head: Commit, rows: DataFrame) -> tuple[list[dict], list[dict]]:
        """Write the parts of the version after ``head``: which hold rows and how many, and which hold changes."""
        folder = f"version={head.version + 1}-{uuid.uuid4().hex[:12]}"
        by = [c for c in (KIND, BUCKET) if c in rows.columns]
        own = F.col(KIND) == DATA if KIND in by else F.lit(True)
        counts = [F.count_if(own).alias("rows")]
        if BUCKET in by and head.buckets <= COUNTED_BUCKETS:
            counts += [F.count_if(own & (F.col(BUCKET) == b)).alias(str(b)) for b in range(head.buckets)]
        seen = Observation()
        checked = changes.require_not_null(rows, head.not_null).observe(seen, *counts)
        checked.write.partitionBy(*by).parquet(self._data(folder))
        top = f"{folder}/{KIND}={DATA}" if KIND in by else folder
        recorded = [p for p in self._parts_in(folder) if f"/{KIND}=" in p and not p.startswith(f"{top}/") and p != top]
        feed = [{"path": p, "kind": p.split(f"{KIND}=", 1)[1].split("/")[0]} for p in recorded]
        if not seen.get["rows"]:
            return [], feed
        if BUCKET not in by:
            return [{"path": top, "rows": seen.get["rows"]}], feed
        found = {b: seen.get[str(b)] for b in range(head.buckets)} if len(counts) > 1 else self._counted(head, top)
        return [{"path": f"{top}/{BUCKET}={b}", "rows": n} for b, n in sorted(found.items()) if n], feed

    def _counted(self, head: Commit, top: str) -> dict[int, int]:
        """Rows by bucket of a table of too many buckets to count while they are written."""
        rows = self.spark.read.schema(T.StructType([*head.struct.fields, T.StructField(BUCKET, T.IntegerType())]))
        return {r[BUCKET]: r["count"] for r in rows.parquet(self._data(top)).groupBy(BUCKET).count().collect()}

    def _rewrite(self, operation: str, condition, change, now) -> int:
        """Replace the parts that hold rows of the condition; carry the others over."""
        head = self._commit()
        touched = self._parts_where(head, condition)
        parts, feed = [], []
        if touched:
            rows = change(self._scan(head, touched))
            if head.buckets:
                # Not shuffled since the scan: tasks still hold whole bucket folders.
                rows = rows.withColumn(BUCKET, self._bucket(head))
            parts, feed = self._write_recorded(head, rows)
        untouched = [p for p in head.parts if p["path"] not in set(touched)]
        shown = condition if isinstance(condition, str) else str(condition)
        return self._publish(self._next(head, operation, untouched + parts, feed, predicate=shown), now)

    def _parts_where(self, head: Commit, condition) -> list[str]:
        """Parts with a row of the condition: a scan of the condition's columns only."""
        if not head.paths:
            return []
        rows = self._scan(head, head.paths, self._part())
        matching = rows.filter(F.expr(condition) if isinstance(condition, str) else condition)
        return sorted(r[0] for r in matching.select("__part").distinct().collect())

    def _parts_with(self, head: Commit, source: DataFrame, keys: list[str], small: bool) -> list[str]:
        """Parts with a key of the source: a scan of the key columns only."""
        if not head.paths:
            return []
        target = self._scan(head, head.paths, self._part()).select("__part", *[F.col(f"`{k}`") for k in keys])
        wanted = source.select(*keys).distinct()
        hits = target.join(F.broadcast(wanted) if small else wanted, keys, "left_semi")
        return sorted(r[0] for r in hits.select("__part").distinct().collect())

    def _has_batch(self, head: Commit, batch: tuple[str, int]) -> bool:
        return head.batches.get(batch[0], -1) >= batch[1]

    @staticmethod
    def _next(head: Commit, operation: str, parts: list[dict], feed: list[dict] | None = None, **params: str) -> Commit:
        return replace(
            head,
            version=head.version + 1,
            operation=operation,
            params=params,
            parts=parts,
            rows=sum(p["rows"] for p in parts),
            feed=feed if feed and head.change_feed else [],
            query_id=None,
            batch_id=None,
        )

    def _publish(self, commit: Commit, now: dt.datetime | None) -> int:
        moment = _utc(now or dt.datetime.now(dt.timezone.utc))
        commit = replace(commit, committed_at=moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ"))
        storage.write_text_once(self.spark, self._file(commit.version), json.dumps(asdict(commit)))
        storage.overwrite_text(self.spark, self._hint(), str(commit.version))
        return commit.version
