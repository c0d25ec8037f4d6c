"""Queries that run a stream over the tables' files and read what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.operators.lookup import enrich
from salespipe.plans.registry import query
from salespipe.plans.relational import ENRICHED, ORDER_STATE
from salespipe.plans.tables import customers, load, nations
from salespipe.session import scratch_dir
from salespipe.sources import readers, writers
from salespipe.streaming.appended import RESCUED, kept_schema, stream_appends, stream_files, widened
from salespipe.streaming.ingest import append_to_path, append_to_table
from salespipe.streaming.upsert import start_upsert, upsert_batch
from salespipe.tables.versioned import VersionedTable


def _land(spark: SparkSession, sf_dir: str, root: str, files: int) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    writers.overwrite_path(orders, f"{root}/landing", files=files)
    return orders


def _ingest(spark: SparkSession, sf_dir: str, root: str, db: str, files: int = 5) -> DataFrame:
    """Enrich landed orders into a bronze table, one file per batch; returns its rows."""
    orders = _land(spark, sf_dir, root, files)
    writers.create_database(spark, db, f"{root}/db")
    stream = readers.stream_parquet(spark, f"{root}/landing", orders.schema, files_per_batch=1)
    bronze = enrich(stream, (customers(spark, sf_dir), "o_custkey"), (nations(spark, sf_dir), "c_nationkey"))
    append_to_table(
        bronze.select(*ENRICHED), f"{db}.bronze", f"{root}/bronze_checkpoint", path=f"{root}/bronze"
    ).awaitTermination()
    return spark.table(f"{db}.bronze")


def _forget(spark: SparkSession, db: str) -> None:
    writers.drop_table(spark, f"{db}.bronze")
    spark.sql(f"DROP DATABASE `{db}`")


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, c_name, c_mktsegment, n_name
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, db = scratch_dir(spark, "ingest"), f"ingest_{uuid.uuid4().hex}"
    bronze = _ingest(spark, sf_dir, root, db)
    found = readers.read_parquet(spark, f"{root}/bronze", bronze.schema)
    _forget(spark, db)
    return found


_NEWEST = """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""


def _upsert_bronze(spark: SparkSession, sf_dir: str, buckets: int, files: int = 3) -> DataFrame:
    root, db = scratch_dir(spark, "merge"), f"merge_{uuid.uuid4().hex}"
    bronze = _ingest(spark, sf_dir, root, db, files).select(*ORDER_STATE)
    silver = VersionedTable.create(
        spark, f"{root}/silver", bronze.schema, not_null="o_custkey",
        bucket_by="o_custkey" if buckets else (), buckets=buckets,
    )
    start_upsert(
        readers.stream_table(spark, f"{db}.bronze", files_per_batch=2).select(*ORDER_STATE),
        silver,
        "o_custkey",
        "o_orderdate",
        f"{root}/silver_checkpoint",
        tie_break="o_orderkey",
        on_match="if_newer",
    ).awaitTermination()
    _forget(spark, db)
    return silver.read()


@query(_NEWEST)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_bronze(spark, sf_dir, buckets=0)


@query(_NEWEST)
def stream_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_bronze(spark, sf_dir, buckets=4)


@query("SELECT * FROM orders")
def stream_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream whose schema is taken from the files already there."""
    root = scratch_dir(spark, "inferred")
    orders = _land(spark, sf_dir, root, 3)
    append_to_path(readers.stream_parquet(spark, f"{root}/landing"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return readers.read_parquet(spark, f"{root}/out", orders.schema)


@query("SELECT * FROM orders")
def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches at a fixed interval, stopped when all files are through."""
    root = scratch_dir(spark, "interval")
    orders = _land(spark, sf_dir, root, 3)
    stream = readers.stream_parquet(spark, f"{root}/landing", orders.schema, files_per_batch=2)
    running = append_to_path(stream, f"{root}/out", f"{root}/checkpoint", every="1 second")
    running.processAllAvailable()
    running.stop()
    return readers.read_parquet(spark, f"{root}/out", orders.schema)


@query("SELECT * FROM orders")
def reset_and_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over every file, a reset of table, data and checkpoint, and the run again: rows come once."""
    root, db = scratch_dir(spark, "reset"), f"reset_{uuid.uuid4().hex}"
    orders = _land(spark, sf_dir, root, 2)
    writers.create_database(spark, db, f"{root}/db")
    for last in (False, True):
        stream = readers.stream_parquet(spark, f"{root}/landing", orders.schema)
        append_to_table(stream, f"{db}.bronze", f"{root}/checkpoint", path=f"{root}/bronze").awaitTermination()
        if not last:
            writers.reset(spark, [f"{db}.bronze"], [f"{root}/bronze", f"{root}/checkpoint"])
    _forget(spark, db)
    return readers.read_parquet(spark, f"{root}/bronze", orders.schema)


@query(f"SELECT *, CAST(2 AS BIGINT) AS versions FROM ({_NEWEST})")
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches, the second sent twice, as after a failure: it is committed once."""
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    table = VersionedTable.create(
        spark, scratch_dir(spark, "replay"), orders.schema, not_null="o_custkey", bucket_by="o_custkey", buckets=4
    )
    apply = upsert_batch(
        table, "o_custkey", "o_orderdate", ties="one", tie_break="o_orderkey", on_match="if_newer", stream_id="replayed"
    )
    apply(orders.filter("o_orderkey % 2 = 0"), 0)
    for _ in range(2):
        apply(orders.filter("o_orderkey % 2 = 1"), 1)
    return table.read().withColumn("versions", F.lit(table.version()).cast("long"))


@query("""
    SELECT seen, o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
    FROM orders, (SELECT unnest(['table', 'stream']) AS seen)
""")
def stream_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later stream brings one more column; table and table stream both have it."""
    root, db = scratch_dir(spark, "evolve"), f"evolve_{uuid.uuid4().hex}"
    orders = load(spark, sf_dir, "orders")
    writers.create_database(spark, db, f"{root}/db")
    bronze = f"{db}.bronze"
    for kind, names in ((0, ["o_orderkey", "o_custkey"]), (1, ["o_orderkey", "o_custkey", "o_orderpriority"])):
        rows = orders.filter(F.col("o_orderkey") % 2 == kind).select(*names)
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = readers.stream_parquet(spark, f"{root}/landing", rows.schema)
        append_to_table(stream, bronze, f"{root}/checkpoint", path=f"{root}/bronze").awaitTermination()
    for seen, write in (("table", None), ("stream", readers.stream_table(spark, bronze))):
        if write is None:
            writers.overwrite_path(spark.table(bronze), f"{root}/{seen}")
        else:
            append_to_path(write, f"{root}/{seen}", f"{root}/checkpoint_{seen}").awaitTermination()
    _forget(spark, db)
    both = [spark.read.parquet(f"{root}/{seen}").withColumn("seen", F.lit(seen)) for seen in ("table", "stream")]
    return both[0].unionByName(both[1]).select("seen", "o_orderkey", "o_custkey", "o_orderpriority")


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders")
def stream_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended to a versioned table, streamed into another one; a second run goes on where the first ended."""
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    root = scratch_dir(spark, "stream-versions")
    source = VersionedTable.create(spark, f"{root}/source", orders.schema)
    target = VersionedTable.create(spark, f"{root}/target", orders.schema)
    upsert = upsert_batch(target, "o_orderkey", "o_orderdate", tie_break="o_totalprice")

    def run() -> None:
        stream_appends(source, upsert, f"{root}/checkpoint", versions_per_batch=2).awaitTermination()

    for i in range(3):
        source.append(orders.filter(F.col("o_orderkey") % 4 == i))
    run()
    source.append(orders.filter("o_orderkey % 4 = 3"))
    run()
    return target.read()


@query("""
    SELECT o_orderkey, o_totalprice,
        CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey % 3 = 1 THEN '{"o_custkey":"C' || o_custkey || '"}' END AS _rescued
    FROM orders
""")
def stream_kept_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three schemas in two runs: a new column widens the kept schema, a value of another type is rescued."""
    orders = load(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("long"))
    root = scratch_dir(spark, "kept-schema")

    def land(i: int, *columns: str | Column) -> None:
        orders.filter(F.col("o_orderkey") % 3 == i).select("o_orderkey", *columns).write.mode("append").parquet(f"{root}/landing")

    def run() -> None:
        def append(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("append").parquet(f"{root}/out")

        stream_files(spark, f"{root}/landing", append, f"{root}/checkpoint").awaitTermination()

    land(0, "o_totalprice", "o_custkey")
    run()
    land(1, "o_totalprice", F.concat(F.lit("C"), "o_custkey").alias("o_custkey"), "o_orderpriority")
    land(2, "o_orderpriority", "o_totalprice", F.col("o_custkey").cast("int").alias("o_custkey"))
    run()
    schema = widened(kept_schema(spark, f"{root}/checkpoint"), T.StructType([T.StructField(RESCUED, T.StringType())]))
    return readers.read_parquet(spark, f"{root}/out", schema)
