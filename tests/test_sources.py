from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from salespipe.session import scratch_dir, shared_root
from salespipe.sources import readers, writers


def text_file(root, name, text):
    with open(f"{root}/{name}", "w") as f:
        f.write(text)
    return f"{root}/{name}"


def test_bad_csv_cells_are_null(spark, root, rows):
    path = text_file(root, "a.csv", "Store,Date,Holiday\n1,2015-07-31,0\nx,2015-07-30,a\n,2015-07-30,\n")
    df = readers.read_csv(spark, path, "Store long, Date timestamp, Holiday string")
    assert [(r.Store, r.Holiday) for r in df.orderBy(F.desc("Date"), F.desc_nulls_last("Holiday")).collect()] == [
        (1, "0"), (None, "a"), (None, None),
    ]
    assert readers.read_csv(spark, text_file(root, "b.csv", "n,s\n1,x\n2,y\n")).dtypes == [("n", "int"), ("s", "string")]


def test_superset_schema(spark, root, rows):
    spark.createDataFrame([(1, "a")], "k long, v string").write.parquet(f"{root}/p")
    assert rows(readers.read_parquet(spark, f"{root}/p", "k long, email string, v string")) == [(1, None, "a")]


def test_merged_schemas(spark, root, rows):
    spark.createDataFrame([(1,)], "k long").write.parquet(f"{root}/p")
    spark.createDataFrame([(2, 0.5)], "k long, r double").write.mode("append").parquet(f"{root}/p")
    assert rows(readers.read_parquet(spark, f"{root}/p", merge_schema=True), "k", "r") == [(1, None), (2, 0.5)]


def test_json_array_file(spark, root, rows):
    path = text_file(root, "r.json", '[\n  {"Store": 598, "Lat": 48.1},\n  {"Store": 7}\n]')
    assert rows(readers.read_json_records(spark, path, "Store int, Lat double", array=True)) == [(7, None), (598, 48.1)]


def test_local_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert [tuple(r) for r in readers.column_types(df).collect()] == [(0, "k", "int"), (1, "v", "string")]


def test_overwrite(spark, root, rows):
    df = spark.range(100)
    writers.overwrite_path(df, f"{root}/p", files=7)
    assert len(spark.read.parquet(f"{root}/p").inputFiles()) == 7
    writers.overwrite_path(spark.range(3), f"{root}/p")
    assert spark.read.parquet(f"{root}/p").count() == 3


def test_months(spark, root):
    df = spark.sql("select explode(sequence(date'2015-01-15', date'2015-12-15', interval 1 day)) as d")
    writers.write_monthly(df, "d", f"{root}/m")
    back = readers.read_parquet(spark, f"{root}/m")
    assert back.count() == df.count()
    one = writers.read_monthly(spark, f"{root}/m", df.schema).filter("month = '2015-02'")
    assert one.count() == 28
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()


def test_tables(spark, root):
    writers.create_database(spark, "lifedb", f"{root}/db", use=True)
    try:
        assert spark.catalog.currentDatabase() == "lifedb"
        writers.create_table(spark, "t", "k long, v string", f"{root}/t")
        writers.create_table(spark, "t", "other long")
        assert spark.table("t").columns == ["k", "v"]
        writers.overwrite_table(spark.range(3), "t", path=f"{root}/t")
        assert spark.table("lifedb.t").columns == ["id"]
        writers.overwrite_table(spark.range(5), "m")
        assert spark.table("m").count() == 5
        writers.reset(spark, ["lifedb.t", "lifedb.m", "lifedb.none"], [f"{root}/t", f"{root}/none"])
        assert not spark.catalog.tableExists("lifedb.t")
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(f"{root}/t")
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE lifedb CASCADE")


def test_every_run_has_its_own_scratch(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(shared_root(spark))


def test_scratch_is_the_folder_the_cluster_names():
    class Cluster:
        """A session of a cluster, as far as naming a folder needs one."""

        class sparkContext:
            master = "spark://somewhere:7077"

        def __init__(self, folder):
            self.conf = {"spark.checkpoint.dir": folder}

    assert scratch_dir(Cluster("hdfs://shared/checkpoints/"), "x").startswith("hdfs://shared/checkpoints/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster(None), "x")
