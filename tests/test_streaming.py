from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salespipe.operators.changes import AmbiguousMerge
from salespipe.operators.latest import latest_per_key
from salespipe.sources import readers, writers
from salespipe.streaming.ingest import append_to_path, append_to_table
from salespipe.streaming.upsert import start_upsert, upsert_batch
from salespipe.tables.versioned import SchemaMismatch, VersionedTable

SCHEMA = "k int, t int, v int"


@pytest.fixture
def landing(spark, root):
    """Five files; key 1 has its newest row in the first of them."""
    path = f"{root}/landing"
    for i in range(5):
        data = [(1, 100 - i, i), (2, i, i), (10 + i, i, i)]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def silver(spark, root):
    return VersionedTable.create(spark, f"{root}/silver", SCHEMA, not_null="k")


def merge(spark, landing, silver, root, **options):
    options = {"tie_break": "v", **options}
    stream = readers.stream_parquet(spark, landing, SCHEMA, files_per_batch=1)
    start_upsert(stream, silver, "k", "t", f"{root}/cp", **options).awaitTermination()


def test_one_file_per_batch_and_no_file_twice(spark, landing, root):
    stream = readers.stream_parquet(spark, landing, SCHEMA, files_per_batch=1)
    query = append_to_path(stream, f"{root}/out", f"{root}/cp")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 5
    assert spark.read.parquet(f"{root}/out").count() == 15
    spark.createDataFrame([(9, 9, 9)], SCHEMA).write.mode("append").parquet(landing)
    append_to_path(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 16


def test_fixed_interval(spark, landing, root):
    stream = readers.stream_parquet(spark, landing, files_per_batch=None)
    assert [f.name for f in stream.schema] == ["k", "t", "v"]
    query = append_to_path(stream, f"{root}/out", f"{root}/cp", every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{root}/out").count() == 15


def test_inference_switch(spark, landing):
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    try:
        assert spark.readStream.parquet(landing).columns == ["k", "t", "v"]
    finally:
        spark.conf.unset("spark.sql.streaming.schemaInference")


def test_new_columns_in_later_batches(spark, landing, root, rows):
    stream = readers.stream_parquet(spark, landing, SCHEMA, files_per_batch=1)
    writers.create_database(spark, "evolving", f"{root}/db")
    try:
        append_to_table(stream, "evolving.bronze", f"{root}/cp1", path=f"{root}/bronze").awaitTermination()
        assert spark.table("evolving.bronze").count() == 15
        spark.createDataFrame([(9, 9, 9)], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        wider = stream.withColumn("w", F.col("v") * 2)
        append_to_table(wider, "evolving.bronze", f"{root}/cp1", path=f"{root}/bronze").awaitTermination()
        for merged in (spark.table("evolving.bronze"), readers.read_parquet(spark, f"{root}/bronze", merge_schema=True)):
            assert rows(merged.filter("w is not null"), "k", "t", "v", "w") == [(9, 9, 9, 18)]
            assert merged.filter("w is null").count() == 15
        assert readers.stream_table(spark, "evolving.bronze").columns == ["k", "t", "v", "w"]
        other = wider.withColumn("w", F.lit("text"))
        with pytest.raises(SchemaMismatch, match="w"):
            append_to_table(other, "evolving.bronze", f"{root}/cp1", path=f"{root}/bronze")
    finally:
        spark.sql("DROP DATABASE evolving CASCADE")


def test_if_newer_is_the_answer_over_all_rows(spark, landing, silver, root, rows):
    merge(spark, landing, silver, root, on_match="if_newer")
    whole = latest_per_key(spark.read.schema(SCHEMA).parquet(landing), "k", "t", ties="one", tie_break="v")
    assert rows(silver.read()) == rows(whole)
    assert silver.version() == 5


def test_replace_lets_the_last_batch_win(spark, landing, silver, root, rows):
    apply = upsert_batch(silver, "k", "t", tie_break="v", stream_id="s")
    apply(spark.createDataFrame([(1, 100, 0), (1, 99, 5)], SCHEMA), 0)
    apply(spark.createDataFrame([(1, 50, 1)], SCHEMA), 1)
    assert rows(silver.read()) == [(1, 50, 1)]


def test_a_restart_goes_on_and_a_replay_has_no_effect(spark, landing, silver, root, rows):
    merge(spark, landing, silver, root, on_match="replace")
    before, version = rows(silver.read()), silver.version()
    stream_id = silver.history().filter("version = 1").first().query_id
    assert stream_id
    merge(spark, landing, silver, root, on_match="replace")
    assert silver.version() == version
    apply = upsert_batch(silver, "k", "t", tie_break="v", stream_id=stream_id)
    apply(spark.createDataFrame([(1, 0, 0)], SCHEMA), 4)
    assert silver.version() == version and rows(silver.read()) == before
    spark.createDataFrame([(77, 1, 1)], SCHEMA).repartition(2).write.mode("append").parquet(landing)
    merge(spark, landing, silver, root, on_match="replace")
    assert silver.version() == version + 1 and (77, 1, 1) in rows(silver.read())


def test_a_new_checkpoint_starts_over(spark, landing, silver, root, rows):
    merge(spark, landing, silver, root, on_match="if_newer")
    before = rows(silver.read())
    stream = readers.stream_parquet(spark, landing, SCHEMA, files_per_batch=1)
    start_upsert(stream, silver, "k", "t", f"{root}/cp2", tie_break="v", on_match="if_newer").awaitTermination()
    assert silver.version() == 10 and rows(silver.read()) == before


def test_a_failed_commit_is_redone(spark, landing, silver, root, monkeypatch, rows):
    real, calls = VersionedTable._publish, []

    def dies_once(self, commit, now):
        calls.append(commit.version)
        if len(calls) == 3:
            raise RuntimeError("the driver went away")
        return real(self, commit, now)

    monkeypatch.setattr(VersionedTable, "_publish", dies_once)
    with pytest.raises(Exception, match="the driver went away"):
        merge(spark, landing, silver, root, on_match="if_newer")
    merge(spark, landing, silver, root, on_match="if_newer")
    assert silver.version() == 5
    whole = latest_per_key(spark.read.schema(SCHEMA).parquet(landing), "k", "t", ties="one", tie_break="v")
    assert rows(silver.read()) == rows(whole)


def test_tied_rows_of_a_batch_are_ambiguous(spark, silver):
    apply = upsert_batch(silver, "k", "t", ties="all", stream_id="s")
    apply(spark.createDataFrame([(1, 1, 1)], SCHEMA), 0)
    with pytest.raises(AmbiguousMerge):
        apply(spark.createDataFrame([(1, 2, 1), (1, 2, 2)], SCHEMA), 1)
