"""Queries through files, catalog tables and versioned tables.

Every run writes below a fresh folder of the shared scratch root.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.functions.scalars import null_flag, safe_ratio
from salespipe.operators import changes, profile
from salespipe.plans.registry import query
from salespipe.plans.relational import ORDER_STATE
from salespipe.plans.tables import lines_with_nulls, load
from salespipe.session import scratch_dir
from salespipe.sources import readers, writers
from salespipe.tables.versioned import VersionedTable, VersionRetired

# ---------------------------------------------------------------- file formats


@query("SELECT *, CAST(NULL AS VARCHAR) AS email FROM customer")
def read_superset_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/customer.parquet"
    known = spark.read.parquet(path).schema
    return readers.read_parquet(spark, path, T.StructType([*known.fields[:2], T.StructField("email", T.StringType()), *known.fields[2:]]))


@query("SELECT * FROM customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    path = scratch_dir(spark, "csv")
    customer.write.option("header", True).csv(path)
    return readers.read_csv(spark, path, customer.schema)


@query("""
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer
""")
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    load(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return readers.read_csv(spark, path)


def write_json_arrays(df: DataFrame, key: str, path: str, per_array: int = 500) -> None:
    """Lines of JSON arrays; a unique integer key bounds each array to ``per_array`` records."""
    record = F.to_json(F.struct(*df.columns))
    arrays = df.groupBy(F.floor(F.col(key) / per_array).alias("g")).agg(F.collect_list(record).alias("records"))
    arrays.select(F.concat(F.lit("["), F.concat_ws(",", "records"), F.lit("]")).alias("value")).write.text(path)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    path = scratch_dir(spark, "json")
    write_json_arrays(customer, "c_custkey", path)
    return readers.read_json_records(spark, path, customer.schema)


@query("SELECT o_orderkey, o_orderdate, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def monthly_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = scratch_dir(spark, "monthly")
    writers.write_monthly(orders, "o_orderdate", path)
    return writers.read_monthly(spark, path, orders.schema)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'")
def monthly_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = monthly_partitions(spark, sf_dir)
    return months.filter("month = '1997-03'").select("o_orderkey", "o_totalprice")


@query("SELECT * FROM orders")
def parquet_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    path = scratch_dir(spark, "rewrite")
    writers.overwrite_path(orders, path, files=30)
    writers.overwrite_path(spark.read.parquet(f"{sf_dir}/orders.parquet"), path, files=8)
    return readers.read_parquet(spark, path, orders.schema)


# The columns of `orders` and their types.
_ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS column_type, count(*) - count({c}) AS nulls FROM orders"
    for i, (c, t) in enumerate(_ORDER_TYPES.items())
))
def column_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return readers.column_types(orders).join(profile.null_counts(orders), "column_name")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice > 1000")
def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    root, db = scratch_dir(spark, "lifecycle"), f"lifecycle_{uuid.uuid4().hex}"
    writers.create_database(spark, db, f"{root}/db")
    writers.create_table(spark, f"{db}.sales", "o_orderkey long, o_totalprice double", f"{root}/sales")
    writers.create_table(spark, f"{db}.sales", "never long", f"{root}/never")
    orders.select("o_orderkey", "o_totalprice").write.insertInto(f"{db}.sales")
    # Replaced by a query, with another schema.
    kept = orders.filter("o_totalprice > 1000").select("o_orderkey", "o_totalprice", "o_orderpriority")
    writers.overwrite_table(kept, f"{db}.sales", path=f"{root}/sales")
    rows = spark.table(f"{db}.sales")
    found = readers.read_parquet(spark, f"{root}/sales", rows.schema)
    # An external table's files outlive its name, so nothing stays in the catalog.
    writers.drop_table(spark, f"{db}.sales")
    spark.sql(f"DROP DATABASE `{db}`")
    return found


# ------------------------------------------------------------ versioned tables

_AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _hours(n: int) -> dt.datetime:
    return _AT + dt.timedelta(hours=n)


def line_versions(spark: SparkSession, sf_dir: str, buckets: int = 0, change_feed: bool = False) -> VersionedTable:
    """0 empty, 1 loaded, 2 high discounts deleted, 3 NULLs set to 0, 4 appended to itself with a ratio."""
    lines = lines_with_nulls(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    table = VersionedTable.create(
        spark, scratch_dir(spark, "lines"), lines.schema, not_null="l_orderkey",
        bucket_by="l_orderkey" if buckets else (), buckets=buckets, change_feed=change_feed, now=_hours(0),
    )
    table.append(lines, now=_hours(1))
    table.delete("l_discount > 0.08", now=_hours(2))
    table.update({"l_discount": 0}, "l_discount is null", now=_hours(3))
    current = table.read().drop("l_tax")
    table.append(current.withColumn("per_unit", safe_ratio("l_quantity", "l_discount")), merge_schema=True, now=_hours(4))
    return table


_V1 = "SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem"
_V2 = f"SELECT * FROM ({_V1}) WHERE NOT coalesce(l_discount > 0.08, false)"
_V3 = f"SELECT * REPLACE (coalesce(l_discount, 0) AS l_discount) FROM ({_V2})"
_V4 = f"""
    SELECT *, CAST(NULL AS DOUBLE) AS per_unit FROM ({_V3})
    UNION ALL BY NAME
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_quantity / nullif(l_discount, 0) AS per_unit FROM ({_V3})
"""


@query(" UNION ALL ".join(
    f"SELECT {v} AS version, count(*) AS rows, CAST(sum(CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls"
    f" FROM ({sql})" for v, sql in enumerate([f"{_V1} LIMIT 0", _V1, _V2, _V3, _V4])
))
def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = line_versions(spark, sf_dir).across(list(range(5)), nulls=null_flag("l_discount"))
    return counted.select(F.col("version").cast("int").alias("version"), "rows", "nulls")


@query(_V4)
def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_versions(spark, sf_dir).read()


@query(_V4)
def append_evolve_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_versions(spark, sf_dir, buckets=4).read()


@query(" UNION ALL ".join(
    f"SELECT CAST({v} AS BIGINT) AS version, TIMESTAMP '2024-01-01 0{v}:00:00' AS committed_at, '{op}' AS operation,"
    f" (SELECT count(*) FROM ({sql})) AS rows"
    for v, (op, sql) in enumerate(
        [("CREATE TABLE", f"{_V1} LIMIT 0"), ("APPEND", _V1), ("DELETE", _V2), ("UPDATE", _V3), ("APPEND", _V4)])
))
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = line_versions(spark, sf_dir).history()
    utc = F.to_utc_timestamp("committed_at", spark.conf.get("spark.sql.session.timeZone")).cast("timestamp_ntz")
    return commits.select("version", utc.alias("committed_at"), "operation", "rows")


@query(_V2)
def read_at_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_versions(spark, sf_dir).read(as_of=_hours(2) + dt.timedelta(minutes=30))


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders")
def append_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    table = VersionedTable.create(spark, scratch_dir(spark, "orders"), orders.schema)
    table.append(orders.filter("o_totalprice < 100000"))
    table.append(orders.filter("o_totalprice >= 100000"))
    return table.read()


@query(f"""
    SELECT CAST(0 AS BIGINT) AS version, CAST(0 AS BIGINT) AS rows
    UNION ALL SELECT 3, count(*) FROM ({_V3})
    UNION ALL SELECT 4, count(*) FROM ({_V4})
    UNION ALL SELECT 5, count(*) FROM ({_V4})
""")
def vacuum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that still read after a vacuum; the last append shares its parts with the version before it."""
    table = line_versions(spark, sf_dir)
    table.vacuum(0.01, check=False, now=_hours(5))
    counts = []
    for version in range(table.version() + 1):
        try:
            rows = table.read(version=version)
        except VersionRetired:
            continue
        counts.append(rows.agg(F.lit(version).cast("long").alias("version"), F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, counts)


_CHANGED = """
    SELECT o_custkey, o_orderkey, o_orderdate,
           CASE WHEN o_orderkey % 7 = 1 THEN 0 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 7 = 0 THEN 'delete' WHEN o_orderkey % 7 = 1 THEN 'update' ELSE 'insert' END AS _change
    FROM orders
    WHERE (o_orderkey % 7 < 2 AND o_orderdate < TIMESTAMP '1999-01-01')
       OR (o_orderkey % 7 > 1 AND o_orderdate >= TIMESTAMP '1999-01-01')
"""


def _changing_orders(spark: SparkSession, sf_dir: str, buckets: int = 0) -> VersionedTable:
    """1 orders before 1999; 2 some deleted; 3 some set to 0; 4 later orders upserted."""
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    border = F.lit("1999-01-01").cast("timestamp_ntz")
    table = VersionedTable.create(
        spark, scratch_dir(spark, "orders"), orders.schema,
        bucket_by="o_orderkey" if buckets else (), buckets=buckets,
    )
    table.append(orders.filter(F.col("o_orderdate") < border))
    table.delete("o_orderkey % 7 = 0")
    table.update({"o_totalprice": 0.0}, "o_orderkey % 7 = 1")
    table.upsert(orders.filter((F.col("o_orderdate") >= border) & (F.col("o_orderkey") % 7 > 1)), "o_orderkey")
    return table


@query(_CHANGED)
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changing_orders(spark, sf_dir).changes(1, 4, "o_orderkey")


@query(_CHANGED)
def change_feed_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changing_orders(spark, sf_dir, buckets=8).changes(1, 4, "o_orderkey")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, 'delete' AS _change, count(*) AS _copies
    FROM (SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem)
    WHERE l_discount > 0.08 GROUP BY ALL
""")
def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_versions(spark, sf_dir).changes(1, 2)


_WHOLE = "l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, CAST(NULL AS DOUBLE) AS per_unit"
_NEWER = """
    SELECT DISTINCT l_orderkey, l_linenumber, 1.0::DOUBLE AS l_quantity, 0.5::DOUBLE AS l_discount, 0.25::DOUBLE AS l_tax
    FROM lineitem WHERE l_orderkey % 10 = 0
"""
_RECORDED = f"""
    SELECT {_WHOLE}, 'insert' AS _change, 1 AS _version FROM ({_V1})
    UNION ALL SELECT {_WHOLE}, 'delete', 2 FROM ({_V1}) WHERE l_discount > 0.08
    UNION ALL SELECT {_WHOLE}, 'update_preimage', 3 FROM ({_V2}) WHERE l_discount IS NULL
    UNION ALL SELECT {_WHOLE}, 'update_postimage', 3 FROM (SELECT * REPLACE (0.0 AS l_discount) FROM ({_V2}) WHERE l_discount IS NULL)
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_discount, NULL, l_quantity / nullif(l_discount, 0), 'insert', 4 FROM ({_V3})
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, per_unit, 'update_preimage', 5
        FROM ({_V4}) WHERE l_orderkey % 10 = 0
    UNION ALL SELECT l_orderkey, l_linenumber, 1.0, 0.5, 0.25, per_unit, 'update_postimage', 5 FROM ({_V4}) WHERE l_orderkey % 10 = 0
    UNION ALL SELECT {_WHOLE}, 'insert', 5 FROM ({_NEWER}) n
        WHERE NOT EXISTS (SELECT 1 FROM ({_V4}) v WHERE v.l_orderkey = n.l_orderkey AND v.l_linenumber = n.l_linenumber)
"""


def _recorded_lines(spark: SparkSession, sf_dir: str, buckets: int = 0) -> VersionedTable:
    """The versions of ``line_versions`` with recorded changes, and 5: every tenth order's lines upserted, all copies of a key."""
    table = line_versions(spark, sf_dir, buckets, change_feed=True)
    newer = load(spark, sf_dir, "lineitem").filter("l_orderkey % 10 = 0").select("l_orderkey", "l_linenumber").distinct()
    values = [F.lit(v).alias(c) for c, v in (("l_quantity", 1.0), ("l_discount", 0.5), ("l_tax", 0.25))]
    table.upsert(newer.select("*", *values), ["l_orderkey", "l_linenumber"], missing="keep", now=_hours(5))
    return table


@query(_RECORDED)
def change_feed_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each write did, as recorded by it; the keys repeat once the table is appended to itself."""
    return _recorded_lines(spark, sf_dir).recorded_changes(1).drop("_committed_at")


@query(f"SELECT * FROM ({_RECORDED}) WHERE _version IN (3, 4, 5)")
def change_feed_recorded_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recorded_lines(spark, sf_dir, buckets=4).recorded_changes(3, 5).drop("_committed_at")


@query("""
    SELECT k % 3 AS kind, count(*) AS n, CAST(sum(CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS changed
    FROM (SELECT o_orderkey AS k FROM orders) GROUP BY 1
""")
def change_feed_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of kind 0 stay, of kind 1 change their price, of kind 2 lose their key: a deletion and a keyless row."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderkey").alias("k"))
    key = F.when(F.col("k") % 3 != 2, F.col("o_orderkey")).alias("o_orderkey")
    price = F.when(F.col("k") % 3 == 1, F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("o_totalprice")
    feed = changes.change_feed(
        orders.unionByName(orders.select(F.lit(None).cast("long").alias("o_orderkey"), "o_totalprice", "k").filter("k % 3 = 2")),
        orders.select(key, price, "k"), "o_orderkey",
    )
    # Kind 2 shows three times: its old keyless row and its key go, its new keyless row comes.
    counted = feed.groupBy("k").agg(F.count_distinct("_change").alias("kinds"), F.count(F.lit(1)).alias("rows"))
    good = F.when(F.col("k") % 3 == 1, F.col("rows") == 1).otherwise((F.col("rows") == 3) & (F.col("kinds") == 2))
    per_order = orders.select("k").join(counted.select("k", good.cast("long").alias("good")), "k", "left")
    return per_order.groupBy((F.col("k") % 3).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("changed")
    )


@query("""
    SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_custkey,
        (o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) / nullif(o_custkey % 10, 0) AS ratio
    FROM orders, (SELECT unnest([1, 2]) AS copy)
    WHERE o_orderkey % 2 = 0 OR (o_orderkey % 3 = 0 AND copy = 1)
""")
def evolve_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table appended to itself with a ratio, then merged with newer prices and new orders: the ratio follows."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    table = VersionedTable.create(spark, scratch_dir(spark, "second"), orders.schema, bucket_by="o_orderkey", buckets=4)
    table.append(orders.filter("o_orderkey % 2 = 0"))
    ratio = F.try_divide(F.col("o_totalprice"), F.nullif(F.col("o_custkey") % 10, F.lit(0)))
    table.append(table.read().withColumn("ratio", ratio), merge_schema=True)
    newer = orders.filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    table.upsert(newer, "o_orderkey", missing="keep")
    table.update({"ratio": ratio}, ~F.col("ratio").eqNullSafe(ratio))
    return table.read()


# The priorities of orders, as local rows.
_PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query("""
    SELECT o_orderkey, o_orderpriority, p.rank FROM orders
    JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) AS p(name, rank)
      ON p.name = o_orderpriority
""")
def local_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = spark.createDataFrame(_PRIORITIES, "o_orderpriority string, rank int")
    return load(spark, sf_dir, "orders").join(ranks, "o_orderpriority").select("o_orderkey", "o_orderpriority", "rank")
