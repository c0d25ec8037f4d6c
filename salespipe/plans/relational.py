"""Queries over tables as they lie: joins, windows, profiles, columns, changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.functions import scalars
from salespipe.functions.conform import conform
from salespipe.operators import changes, profile
from salespipe.operators.encode import category_codes as add_category_codes
from salespipe.operators.encode import category_codes_of
from salespipe.operators.latest import latest_by_maximum, latest_per_key
from salespipe.operators.lookup import enrich, join_lookup
from salespipe.operators.split import in_first_part
from salespipe.plans.registry import query
from salespipe.plans.tables import customers, lines_with_nulls, load, nations, null_if

ENRICHED = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "c_name", "c_mktsegment", "n_name"]
ORDER_STATE = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *NUMBERS]

# ------------------------------------------------------------ joins, windows


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, c_name, c_mktsegment, n_name
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def flagship_enriched_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The joins look up attributes of the window's key, so they commute with it;
    # taking the latest order first leaves one row per customer to join.
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    newest = latest_per_key(orders, "o_custkey", "o_orderdate", ties="one", tie_break="o_orderkey")
    return enrich(
        newest, (customers(spark, sf_dir), "o_custkey"), (nations(spark, sf_dir), "c_nationkey")
    ).select(*ENRICHED)


_BUILDING = """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, c_name, c_mktsegment, n_name
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE c_mktsegment = 'BUILDING'
"""


@query(_BUILDING)
def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = customers(spark, sf_dir).filter("c_mktsegment = 'BUILDING'")
    orders = load(spark, sf_dir, "orders")
    return enrich(orders, (some, "o_custkey"), (nations(spark, sf_dir), "c_nationkey")).select(*ENRICHED)


@query(_BUILDING)
def enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = customers(spark, sf_dir).filter("c_mktsegment = 'BUILDING'")
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    joined = join_lookup(orders, some, "o_custkey", salt=4, salt_by="o_orderkey")
    return enrich(joined, (nations(spark, sf_dir), "c_nationkey")).select(*ENRICHED)


_TIES = """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1
"""


@query(_TIES)
def latest_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    return latest_per_key(orders, "o_custkey", "o_orderdate", ties="all", few_ties=True)


@query(_TIES)
def latest_ties_by_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_maximum(load(spark, sf_dir, "orders").select(*ORDER_STATE), "o_custkey", "o_orderdate")


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_one_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(*ORDER_STATE)
    return latest_per_key(orders, "o_custkey", "o_orderdate", ties="one", tie_break="o_orderkey")


# ------------------------------------------------------------------ profiles


@query("SELECT CAST(sum(CASE WHEN nullif(l_discount, 0) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS l_discount_NULL FROM lineitem")
def null_count_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_count(lines_with_nulls(spark, sf_dir), "l_discount")


_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(
    "WITH t AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_returnflag, 'N') AS l_returnflag)"
    " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM t" for c in _LINE_COLUMNS
    )
)
def null_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(lines_with_nulls(spark, sf_dir).withColumn("l_returnflag", null_if("l_returnflag", "N")))


def _corr_sql(names: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) + 0.0 AS r FROM {table}" for x in names for y in names
    )


@query(
    "WITH t AS (SELECT * REPLACE (coalesce(nullif(l_discount, 0), 0) AS l_discount) FROM lineitem) "
    + _corr_sql(LINE_NUMBERS, "t")
)
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = profile.correlation_matrix(lines_with_nulls(spark, sf_dir))
    return matrix.withColumn("r", F.round("r", 6) + F.lit(0.0))


@query(
    "WITH t AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) + 0.0 AS r FROM t"
        f" WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
        for x in NUMBERS
        for y in NUMBERS
    )
)
def corr_matrix_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_with_nulls(spark, sf_dir).withColumn("l_tax", null_if("l_tax", 0.0))
    matrix = profile.correlation_matrix(lines, NUMBERS, fill=None)
    return matrix.withColumn("r", F.round("r", 6) + F.lit(0.0))


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(load(spark, sf_dir, "orders"), "o_orderpriority")


@query("""
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(last_day(o_orderdate) AS DATE) AS month_end,
           count(*) AS orders, round(sum(o_totalprice), 2) AS sales
    FROM orders GROUP BY ALL
""")
def monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.monthly(
        load(spark, sf_dir, "orders"),
        "o_orderdate",
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("o_totalprice"), 2).alias("sales"),
    )


@query("""
    WITH t AS (SELECT l_extendedprice AS y, 1500 * l_quantity AS p FROM lineitem)
    SELECT count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(avg((y - p) * (y - p)), 2) AS mse,
           round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2
    FROM t
""")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    guessed = load(spark, sf_dir, "lineitem").withColumn("guess", 1500 * F.col("l_quantity"))
    found = profile.regression_metrics(guessed, "l_extendedprice", "guess")
    return found.select(
        "n", F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2")
    )


# ----------------------------------------------------------- columns, filters


@query("""
    SELECT o_orderkey AS order_id, CAST(trunc(o_totalprice) AS INTEGER) AS price, -o_totalprice AS loss,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS closed,
           'order-' || CAST(o_orderkey AS VARCHAR) || '/' || o_orderstatus AS label, '2024-01-31' AS exported_on
    FROM orders
""")
def project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        scalars.truncate_to_int("o_totalprice").alias("price"),
        (-F.col("o_totalprice")).alias("loss"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("closed"),
        F.format_string("order-%d/%s", "o_orderkey", "o_orderstatus").alias("label"),
        scalars.day_label(dt.date(2024, 1, 31)).alias("exported_on"),
    )


@query("SELECT * REPLACE (coalesce(nullif(l_discount, 0), 0) AS l_discount) FROM lineitem")
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_with_nulls(spark, sf_dir).na.fill(0)


@query("SELECT * EXCLUDE (l_returnflag, l_linestatus, l_shipdate) FROM lineitem")
def drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").drop("l_returnflag", "l_linestatus", "l_shipdate", "l_linestatus")


@query("SELECT * FROM orders WHERE o_custkey < 150")
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").filter("o_custkey < 150")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE nullif(l_discount, 0) IS NULL")
def is_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_with_nulls(spark, sf_dir).filter(F.col("l_discount").isNull())
    return lines.select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(5)


@query("SELECT l_orderkey, l_linenumber, l_tax / nullif(l_discount, 0) AS ratio FROM lineitem")
def ratio_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", scalars.safe_ratio("l_tax", "l_discount").alias("ratio")
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    as_text = orders.select(*[F.col(c).cast("string").alias(c) for c in reversed(orders.columns)])
    return conform(as_text, orders.schema)


@query("""
    SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS whole, TRY_CAST(o_orderpriority[1:1] AS DOUBLE) AS head
    FROM orders
""")
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.coerce_number("o_orderpriority").alias("whole"),
        scalars.coerce_number(F.substring("o_orderpriority", 1, 1)).alias("head"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS ordered_at FROM orders
""")
def parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    text = F.concat(
        F.when(F.col("o_orderstatus") == "P", "on ").otherwise(""), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    return orders.select("o_orderkey", scalars.parse_timestamp(text).cast("timestamp_ntz").alias("ordered_at"))


_CODES = """
    WITH t AS (SELECT {key} AS k, {value} AS v FROM {table}),
         codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM t WHERE v IS NOT NULL))
    SELECT t.k AS {key}, coalesce(codes.code, -1) AS code FROM t LEFT JOIN codes ON codes.v = t.v
"""


@query(_CODES.format(key="o_orderkey", value="nullif(o_orderpriority, '5-LOW')", table="orders"))
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", null_if("o_orderpriority", "5-LOW").alias("priority"))
    return add_category_codes(orders, "priority", "code").drop("priority")


@query(_CODES.format(key="c_custkey", value="c_name", table="customer"))
def category_codes_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return add_category_codes(names, "c_name", "code").drop("c_name")


@query("""
    SELECT o_orderkey,
        CASE WHEN o_orderpriority = '5-LOW' THEN -1 ELSE dense_rank() OVER (ORDER BY nullif(o_orderpriority, '5-LOW') NULLS LAST) - 1 END
            AS o_orderpriority_code,
        dense_rank() OVER (ORDER BY o_orderdate) - 1 AS o_orderdate_code,
        dense_rank() OVER (ORDER BY o_totalprice) - 1 AS o_totalprice_code
    FROM orders
""")
def category_codes_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a text, a time and a number column, from one pass over the table."""
    columns = ["o_orderpriority", "o_orderdate", "o_totalprice"]
    orders = load(spark, sf_dir, "orders").withColumn("o_orderpriority", null_if("o_orderpriority", "5-LOW"))
    return category_codes_of(orders.select("o_orderkey", *columns), columns).drop(*columns)


@query("SELECT c_custkey, regexp_replace(c_name, '\\W+', '_', 'g') AS name FROM customer")
def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", scalars.sanitize_name("c_name").alias("name"))


_PERCENT = "CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 4) AS INTEGER) % 100"


@query(f"""
    SELECT o_orderkey, CASE WHEN {_PERCENT.format("o_orderkey")} < 75 THEN 'train' ELSE 'test' END AS part FROM orders
""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(in_first_part("o_orderkey"), "train").otherwise("test")
    return load(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"))


# -------------------------------------------------------------------- changes


@query("SELECT * FROM orders")
def not_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.require_not_null(load(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"])


def _state(df: DataFrame) -> DataFrame:
    return latest_per_key(df.select(*ORDER_STATE), "o_custkey", "o_orderdate", ties="one", tie_break="o_orderkey")


def _in_time(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(state before 1998, newest rows since) of every customer."""
    orders = load(spark, sf_dir, "orders")
    border = F.lit("1998-01-01").cast("timestamp_ntz")
    return _state(orders.filter(F.col("o_orderdate") < border)), _state(orders.filter(F.col("o_orderdate") >= border))


_LATEST = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
_UPSERT = f"""
    WITH t AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
               WHERE o_orderdate < TIMESTAMP '1998-01-01' QUALIFY {_LATEST}),
         s AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
               WHERE o_orderdate >= TIMESTAMP '1998-01-01' QUALIFY {_LATEST})
    SELECT o_custkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderkey ELSE s.o_orderkey END AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice
    FROM t FULL JOIN s USING (o_custkey)
"""


@query(_UPSERT)
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _in_time(spark, sf_dir)
    return changes.upsert(target, source, "o_custkey")


@query(_UPSERT)
def upsert_large_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _in_time(spark, sf_dir)
    return changes.upsert(target, source, "o_custkey", broadcast_limit=0)


@query(f"""
    WITH t AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
               WHERE {_PERCENT.format("o_orderkey")} < 50 QUALIFY {_LATEST}),
         s AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
               WHERE {_PERCENT.format("o_orderkey")} >= 50 QUALIFY {_LATEST}),
         b AS (SELECT o_custkey, t.o_orderkey AS tk, t.o_orderdate AS td, t.o_totalprice AS tp,
                      s.o_orderkey AS sk, s.o_orderdate AS sd, s.o_totalprice AS sp,
                      s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR s.o_orderdate > t.o_orderdate
                      OR (s.o_orderdate = t.o_orderdate AND s.o_orderkey > t.o_orderkey)) AS newer
               FROM t FULL JOIN s USING (o_custkey))
    SELECT o_custkey, CASE WHEN newer THEN sk ELSE tk END AS o_orderkey,
           CASE WHEN newer THEN sd ELSE td END AS o_orderdate, CASE WHEN newer THEN sp ELSE tp END AS o_totalprice
    FROM b
""")
def upsert_if_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    first = in_first_part("o_orderkey", percent=50)
    return changes.upsert(
        _state(orders.filter(first)),
        _state(orders.filter(~first)),
        "o_custkey",
        on_match="if_newer",
        newer_by=["o_orderdate", "o_orderkey"],
    )


@query(f"""
    WITH t AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
               WHERE o_orderdate < TIMESTAMP '1998-01-01' QUALIFY {_LATEST}),
         s AS (SELECT o_custkey, o_orderkey, o_orderdate FROM orders
               WHERE o_orderdate >= TIMESTAMP '1998-01-01' QUALIFY {_LATEST})
    SELECT o_custkey, coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate, t.o_totalprice
    FROM t FULL JOIN s USING (o_custkey)
""")
def upsert_keep_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _in_time(spark, sf_dir)
    return changes.upsert(target, source.drop("o_totalprice"), "o_custkey", missing="keep")


@query("""
    WITH t AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount) FROM lineitem)
    SELECT * FROM t WHERE NOT coalesce(l_discount > 0.05, false)
""")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.delete_where(lines_with_nulls(spark, sf_dir), "l_discount > 0.05")


@query("""
    WITH t AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount) FROM lineitem)
    SELECT * REPLACE (CASE WHEN l_discount IS NULL THEN 0 ELSE l_discount END AS l_discount) FROM t
""")
def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.update_where(lines_with_nulls(spark, sf_dir), {"l_discount": 0}, "l_discount is null")


@query("""
    SELECT l_suppkey, l_returnflag, CASE WHEN n > 0 THEN 'insert' ELSE 'delete' END AS _change,
           CAST(abs(n) AS BIGINT) AS _copies
    FROM (SELECT l_suppkey, l_returnflag, count(*) FILTER (l_linestatus = 'F') - count(*) FILTER (l_linestatus = 'O') AS n
          FROM lineitem GROUP BY ALL)
    WHERE n <> 0
""")
def row_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    before = lines.filter("l_linestatus = 'O'").select("l_suppkey", "l_returnflag")
    after = lines.filter("l_linestatus = 'F'").select("l_suppkey", "l_returnflag")
    return changes.row_difference(before, after)
