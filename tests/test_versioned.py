from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salespipe.operators.changes import AmbiguousMerge
from salespipe.sources import storage
from salespipe.tables.versioned import (
    NoChangeFeed,
    NotAppended,
    SchemaMismatch,
    VersionedTable,
    VersionNotFound,
    VersionRetired,
)

SCHEMA = "k int, v int, d int"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def hour(n):
    return START + dt.timedelta(hours=n)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture(params=[0, 4], ids=["plain", "bucketed"])
def table(spark, root, request):
    return VersionedTable.create(
        spark, f"{root}/t", SCHEMA, not_null="k", now=hour(0),
        bucket_by="k" if request.param else (), buckets=request.param,
    )


def test_every_write_is_a_version(spark, table, rows):
    assert table.version() == 0 and table.read().count() == 0
    table.append(frame(spark, (1, 10, 1), (2, None, 1)), now=hour(1))
    table.upsert(frame(spark, (2, None, 2), (3, 30, 2)), "k", now=hour(2))
    table.delete("k = 1", now=hour(3))
    table.update({"v": 0}, "v is null", now=hour(4))
    table.overwrite(frame(spark, (9, 9, 9)), now=hour(5))
    assert rows(table.read(version=0)) == []
    assert rows(table.read(version=1)) == [(1, 10, 1), (2, None, 1)]
    assert rows(table.read(version=2)) == [(1, 10, 1), (2, None, 2), (3, 30, 2)]
    assert rows(table.read(version=3)) == [(2, None, 2), (3, 30, 2)]
    assert rows(table.read(version=4)) == [(2, 0, 2), (3, 30, 2)]
    assert rows(table.read()) == [(9, 9, 9)]
    log = table.history().orderBy("version").collect()
    assert [r.operation for r in log] == ["CREATE TABLE", "APPEND", "MERGE", "DELETE", "UPDATE", "OVERWRITE"]
    assert [r.rows for r in log] == [0, 2, 3, 2, 2, 1]
    assert log[3].params == {"predicate": "k = 1"}


def test_as_of(spark, table, rows):
    table.append(frame(spark, (1, 1, 1)), now=hour(1))
    table.append(frame(spark, (2, 2, 2)), now=hour(2))
    assert rows(table.read(as_of=hour(1.5))) == [(1, 1, 1)]
    assert rows(table.read(as_of=hour(2))) == [(1, 1, 1), (2, 2, 2)]
    with pytest.raises(VersionNotFound):
        table.read(as_of=hour(-1))
    with pytest.raises(VersionNotFound):
        table.read(version=7)


def test_create_leaves_an_existing_table(spark, table):
    table.append(frame(spark, (1, 1, 1)))
    again = VersionedTable.create(spark, table.root, "other string")
    assert again.version() == 1 and again.read().columns == ["k", "v", "d"]


def test_append_checks_the_schema(spark, table, rows):
    table.append(frame(spark, (1, 1, 1)))
    other = spark.createDataFrame([(2, 2.5)], "k int, ratio double")
    with pytest.raises(SchemaMismatch, match="missing column v.*new column ratio"):
        table.append(other)
    with pytest.raises(SchemaMismatch, match="column v is string"):
        table.append(spark.createDataFrame([(1, "a", 1)], "k int, v string, d int"), merge_schema=True)
    assert table.version() == 1
    table.append(other, merge_schema=True)
    assert table.read().columns == ["k", "v", "d", "ratio"]
    assert rows(table.read()) == [(1, 1, 1, None), (2, None, None, 2.5)]
    assert table.read(version=1).columns == ["k", "v", "d"]


def test_not_null_is_enforced(spark, table):
    with pytest.raises(Exception, match="NOT NULL constraint failed: k"):
        table.append(frame(spark, (None, 1, 1)))
    with pytest.raises(Exception, match="NOT NULL constraint failed: k"):
        table.upsert(frame(spark, (None, 1, 1)), "k")
    assert table.version() == 0
    table.append(frame(spark, (1, 1, 1)))
    assert table.read().count() == 1


def test_ambiguous_upsert_leaves_no_version(spark, table):
    table.append(frame(spark, (1, 1, 1)))
    with pytest.raises(AmbiguousMerge):
        table.upsert(frame(spark, (1, 2, 2), (1, 3, 3)), "k")
    assert table.version() == 1


def test_self_append_doubles_every_key_and_later_upserts_keep_both(spark, table, rows):
    table.append(frame(spark, (1, 10, 1), (2, 20, 0)))
    now = table.read().drop("d").withColumn("r", F.lit(0.5))
    table.append(now, merge_schema=True)
    assert table.read().groupBy("k").count().filter("count = 2").count() == 2
    with pytest.raises(ValueError, match="lacks"):
        table.upsert(frame(spark, (1, 99, 9)), "k")
    table.upsert(frame(spark, (1, 99, 9)), "k", missing="keep")
    assert rows(table.read().filter("k = 1"), "v", "d", "r") == [(99, 9, None), (99, 9, 0.5)]


def test_a_replayed_batch_is_skipped(spark, table, rows):
    table.upsert(frame(spark, (1, 1, 1)), "k", batch=("s", 0))
    table.upsert(frame(spark, (1, 2, 2)), "k", batch=("s", 1))
    assert table.upsert(frame(spark, (1, 7, 7)), "k", batch=("s", 0)) == 2
    table.upsert(frame(spark, (2, 2, 2)), "k", batch=("other", 0))
    assert rows(table.read()) == [(1, 2, 2), (2, 2, 2)]
    assert [(r.query_id, r.batch_id) for r in table.history().orderBy("version").collect()][1:] == [
        ("s", 0), ("s", 1), ("other", 0),
    ]


def test_vacuum_retires_what_no_recent_version_needs(spark, root, rows):
    table = VersionedTable.create(spark, f"{root}/t", SCHEMA, now=hour(0))
    table.append(frame(spark, (1, None, 1), (2, 2, 2)), now=hour(1))
    table.delete("v is null", now=hour(2))
    table.append(frame(spark, (3, 3, 3)), now=hour(3))
    with pytest.raises(ValueError, match="retention"):
        table.vacuum(0.01, now=hour(4))
    assert table.vacuum(now=hour(4)) == []
    assert [p.split("-")[0] for p in table.vacuum(0.01, check=False, now=hour(4))] == ["version=1"]
    with pytest.raises(VersionRetired):
        table.read(version=1)
    # The append only added a part, so the version before it still reads.
    assert rows(table.read(version=2)) == [(2, 2, 2)]
    assert rows(table.read()) == [(2, 2, 2), (3, 3, 3)]
    assert [r.operation for r in table.history().orderBy("version").collect()][-1] == "VACUUM"
    assert table.history().count() == 6


def test_writes_touch_only_the_parts_they_must(spark, root, rows):
    table = VersionedTable.create(spark, f"{root}/t", SCHEMA, bucket_by="k", buckets=8)
    table.append(spark.range(100).selectExpr("cast(id as int) k", "0 v", "0 d"))
    full = {p["path"] for p in table._commit().parts}
    assert len(full) == 8
    table.upsert(frame(spark, (5, 1, 1)), "k")
    assert len({p["path"] for p in table._commit().parts} & full) == 7
    table.delete("k = 6")
    assert len({p["path"] for p in table._commit().parts} & full) in (6, 7)
    table.append(frame(spark, (1000, 1, 1)))
    assert len(table._commit().parts) == 9
    assert table.read().count() == 100
    assert rows(table.changes(1, table.version(), "k")) == [
        (5, 1, 1, "update"), (6, 0, 0, "delete"), (1000, 1, 1, "insert"),
    ]


def test_large_sources_are_shuffled_into_buckets(spark, root):
    table = VersionedTable.create(spark, f"{root}/t", SCHEMA, bucket_by="k", buckets=4)
    table.append(spark.range(50).selectExpr("cast(id as int) k", "0 v", "0 d"))
    table.upsert(spark.range(25, 75).selectExpr("cast(id as int) k", "1 v", "1 d"), "k", broadcast_limit=0)
    assert table.read().count() == 75 and table.read().filter("v = 1").count() == 50
    assert len(table._commit().parts) == 4


def test_half_written_versions_are_replaced(spark, table, rows):
    table.append(frame(spark, (1, 1, 1)))
    # What a job leaves that died before its commit.
    frame(spark, (8, 8, 8)).write.parquet(f"{table.root}/data/version=2")
    assert rows(table.read()) == [(1, 1, 1)]
    table.append(frame(spark, (2, 2, 2)))
    assert rows(table.read()) == [(1, 1, 1), (2, 2, 2)]


def test_two_writers_of_one_version_clash(spark, table):
    commit = table._next(table._commit(), "APPEND", [])
    table._publish(commit, None)
    with pytest.raises(FileExistsError):
        table._publish(commit, None)


def test_a_losing_writer_leaves_the_winners_rows_alone(spark, root, rows):
    table = VersionedTable.create(spark, f"{root}/t", SCHEMA)
    table.append(frame(spark, (1, 1, 1)))
    head = table._commit()
    parts = table._write(head, frame(spark, (3, 3, 3)))
    table.append(frame(spark, (2, 2, 2)))
    with pytest.raises(FileExistsError):
        table._publish(table._next(head, "APPEND", head.parts + parts), None)
    assert rows(table.read(version=2)) == [(1, 1, 1), (2, 2, 2)] == rows(table.read())
    # The loser's folder is nobody's part, so a vacuum takes it.
    lost = parts[0]["path"]
    assert lost in table.vacuum(0, check=False)
    assert rows(table.read()) == [(1, 1, 1), (2, 2, 2)]


@pytest.mark.parametrize("buckets", [0, 8])
def test_changes_leave_parts_without_their_rows_alone(spark, root, buckets):
    table = VersionedTable.create(spark, f"{root}/t", SCHEMA, bucket_by="k" if buckets else (), buckets=buckets)
    for start in (0, 50):
        table.append(spark.range(start, start + 50).selectExpr("cast(id as int) k", "0 v", "0 d"))
    before = {p["path"] for p in table._commit().parts}
    table.delete("k = 1000")
    table.update({"v": 1}, "k = 1000")
    assert {p["path"] for p in table._commit().parts} == before and table._commit().rows == 100
    table.upsert(frame(spark, (5, 1, 1)), "k")
    after = table._commit()
    # Each load has a part of its own in every bucket; only those of the key's bucket go.
    assert len(before - set(after.paths)) == (2 if buckets else 1)
    assert after.rows == 100 and table.read().filter("v = 1").count() == 1


def test_versions_are_unchanged_by_later_writes(spark, table, rows):
    table.append(frame(spark, (1, 1, 1), (2, 2, 2), (3, 3, 3)))
    first = rows(table.read(version=1))
    table.update({"v": 5}, "k > 1")
    table.delete("k = 3")
    table.overwrite(frame(spark))
    assert rows(table.read(version=1)) == first and rows(table.read()) == []


def test_storage_helpers(spark, root):
    storage.write_text_once(spark, f"{root}/a/b.txt", "héllo")
    assert storage.read_text(spark, f"{root}/a/b.txt") == "héllo"
    assert storage.list_names(spark, f"{root}/a") == ["b.txt"] and storage.list_names(spark, f"{root}/z") == []


@pytest.mark.parametrize("hint", [None, "0", "", "x"])
def test_the_newest_version_is_found_with_a_stale_or_no_hint(spark, root, rows, hint):
    table = VersionedTable.create(spark, f"{root}/t", SCHEMA)
    table.append(frame(spark, (1, 1, 1)))
    table.append(frame(spark, (2, 2, 2)))
    if hint is None:
        storage.delete_folder(spark, table._hint())
    else:
        storage.overwrite_text(spark, table._hint(), hint)
    assert table.version() == 2 and table.read().count() == 2
    assert not VersionedTable(spark, f"{root}/none").exists()


@pytest.fixture(params=[0, 4, 100], ids=["plain", "bucketed", "many buckets"])
def recorded(spark, root, request):
    return VersionedTable.create(
        spark, f"{root}/r", SCHEMA, now=hour(0), change_feed=True,
        bucket_by="k" if request.param else (), buckets=request.param,
    )


def test_every_write_records_what_it_changed(spark, recorded, rows):
    table = recorded
    table.append(frame(spark, (1, 10, 1), (2, None, 1), (None, 5, 1)), now=hour(1))
    table.append(table.read().filter("k = 1"), now=hour(2))  # the key repeats
    table.upsert(frame(spark, (1, 11, 2), (3, 30, 2), (None, 7, 2)), "k", now=hour(3))
    table.update({"v": 0}, "v is null", now=hour(4))
    table.delete("k = 1", now=hour(5))
    table.delete("k = 77", now=hour(6))
    table.overwrite(frame(spark, (9, 9, 9)), now=hour(7))
    assert rows(table.read(version=5)) == [(None, 5, 1), (None, 7, 2), (2, 0, 1), (3, 30, 2)]
    found = table.recorded_changes(1)
    assert found.columns == ["k", "v", "d", "_change", "_version", "_committed_at"]
    assert rows(found.drop("_committed_at")) == rows(spark.createDataFrame([
        (1, 10, 1, "insert", 1), (2, None, 1, "insert", 1), (None, 5, 1, "insert", 1), (1, 10, 1, "insert", 2),
        (1, 10, 1, "update_preimage", 3), (1, 11, 2, "update_postimage", 3), (1, 10, 1, "update_preimage", 3),
        (1, 11, 2, "update_postimage", 3), (3, 30, 2, "insert", 3), (None, 7, 2, "insert", 3),
        (2, None, 1, "update_preimage", 4), (2, 0, 1, "update_postimage", 4),
        (1, 11, 2, "delete", 5), (1, 11, 2, "delete", 5),
        (None, 5, 1, "delete", 7), (None, 7, 2, "delete", 7), (2, 0, 1, "delete", 7), (3, 30, 2, "delete", 7), (9, 9, 9, "insert", 7),
    ], "k int, v int, d int, _change string, _version long"))
    assert {r._version: r._committed_at.hour for r in found.collect()} == {v: v for v in (1, 2, 3, 4, 5, 7)}
    assert rows(table.recorded_changes(4, 5), "_version") == [(4,), (4,), (5,), (5,)]
    assert table.recorded_changes(6, 6).count() == 0


def test_changes_applied_to_a_version_give_the_next(spark, recorded, rows):
    table = recorded
    table.append(frame(spark, *[(i % 7, i, 0) for i in range(40)]))
    table.upsert(frame(spark, *[(i, 1000 + i, 1) for i in range(3, 12)]), "k")
    table.update({"v": -1}, "v % 2 = 0")
    table.delete("k < 3")
    for version in range(2, 5):
        feed = table.recorded_changes(version, version)
        gained = feed.filter("_change in ('insert', 'update_postimage')").select("k", "v", "d")
        lost = feed.filter("_change in ('delete', 'update_preimage')").select("k", "v", "d")
        assert rows(table.read(version=version - 1).unionByName(gained).exceptAll(lost)) == rows(table.read(version=version))


def test_the_feed_opens_the_folders_of_changes_only(spark, recorded):
    table = recorded
    table.append(frame(spark, *[(i, i, 0) for i in range(50)]))
    table.update({"v": 0}, "k = 3")
    files = [f for f in table.recorded_changes(2).inputFiles() if f.endswith(".parquet")]
    assert files and all("/change_kind=update_" in f for f in files)


def test_a_table_without_a_feed_says_so(spark, table):
    table.append(frame(spark, (1, 1, 1)))
    with pytest.raises(NoChangeFeed):
        table.recorded_changes(1)


def test_vacuum_retires_recorded_changes_with_their_versions(spark, recorded, rows):
    table = recorded
    table.append(frame(spark, (1, 1, 1), (2, 2, 2)), now=hour(1))
    table.update({"v": 5}, "k = 1", now=hour(2))
    table.update({"v": 6}, "k = 1", now=hour(20))
    table.vacuum(10, check=False, now=hour(21))
    assert rows(table.read(version=2)) == [(1, 5, 1), (2, 2, 2)]
    assert rows(table.recorded_changes(3), "v", "_change") == [(5, "update_preimage"), (6, "update_postimage")]
    with pytest.raises(VersionRetired):
        table.recorded_changes(2)


def test_versions_are_compared_in_one_scan_of_their_parts(spark, table):
    for i in range(3):
        table.append(frame(spark, *[(j, j if j % 2 else None, i) for j in range(10)]))
    table.delete("d = 1")
    found = table.across([0, 1, 3, 4], v=F.coalesce(F.col("v"), F.lit(0)), nulls=F.col("v").isNull().cast("int"))
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, None, None), (1, 10, 25, 5), (3, 30, 75, 15), (4, 20, 50, 10)]
    # The plan that ran; the text shows the one it began as after it.
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_rows_of_appends_alone(spark, table, rows):
    table.append(frame(spark, (1, 1, 1)))
    table.append(frame(spark, (2, 2, 2)))
    assert rows(table.appended_by([0, 1, 2])) == [(1, 1, 1), (2, 2, 2)]
    assert rows(table.appended_by([2])) == [(2, 2, 2)]
    table.delete("k = 1")
    with pytest.raises(NotAppended):
        table.appended_by([2, 3])
