"""The store-sales job: landing files → bronze → silver → features → gold.

Every step is a Spark job over files of any size; the folders, database and
model root are parameters.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.functions.scalars import safe_ratio
from salespipe.model import regression
from salespipe.operators.encode import category_codes
from salespipe.operators.lookup import enrich
from salespipe.operators.profile import correlation_matrix, null_counts
from salespipe.operators.split import hash_split
from salespipe.sources import readers, writers
from salespipe.streaming.ingest import append_to_table
from salespipe.streaming.upsert import start_upsert
from salespipe.tables.versioned import VersionedTable

# The column layouts of the files and tables this job reads and writes.
TRANSACTIONS = (
    "Store long, DayOfWeek long, Date timestamp, Sales long, Customers long, Open long, Promo long, "
    "StateHoliday string, SchoolHoliday long"
)
STORE_STATES = "Store long, State string, Latitude float, Longitude float"
STORES = (
    "Store long, StoreType string, Assortment string, CompetitionDistance long, CompetitionOpenSinceMonth long, "
    "CompetitionOpenSinceYear long, Promo2 long, Promo2SinceWeek long, Promo2SinceYear long, PromoInterval string"
)
SILVER = (
    "Store INT NOT NULL, DayOfWeek INT, Sales INT, Customers INT, Open INT, Promo INT, StateHoliday STRING, "
    "SchoolHoliday INT, Date TIMESTAMP, State STRING, Latitude FLOAT, Longitude FLOAT, StoreType INT, "
    "Assortment STRING, CompetitionDistance INT, CompetitionOpenSinceMonth INT, CompetitionOpenSinceYear INT, "
    "Promo2 INT, Promo2SinceWeek INT, Promo2SinceYear INT, PromoInterval STRING"
)
FEATURES = [
    "Store", "DayOfWeek", "Customers", "Open", "Promo", "SchoolHoliday", "Latitude", "Longitude",
    "CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek",
    "Promo2SinceYear",
]
LABEL = "Sales"

SCORING_RECORD = (
    "Store int, DayOfWeek int, Customers int, Promo int, Latitude double, Longitude double, CompetitionDistance int, "
    "CompetitionOpenSinceMonth int, CompetitionOpenSinceYear int, Promo2 int, Promo2SinceWeek int, "
    "Promo2SinceYear int, Open int, SchoolHoliday int"
)


@dataclass(frozen=True)
class Layout:
    """Where a run reads and writes. A fresh ``root`` replays everything."""

    landing: str
    states_csv: str
    stores_csv: str
    root: str
    database: str

    @property
    def bronze(self) -> str:
        return f"{self.database}.bronze_sales"

    @property
    def gold(self) -> str:
        return f"{self.database}.gold_sales"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def land_csv(spark: SparkSession, csv: str, landing: str, *, files: int | None = None) -> None:
    """Raw CSV to parquet landing files, ``files`` of even size or as many as its splits."""
    writers.overwrite_path(readers.read_csv(spark, csv, TRANSACTIONS), landing, files=files)


def land_monthly(spark: SparkSession, csv: str, path: str) -> None:
    """Raw CSV to one folder per month, with the holiday kind as a category code."""
    rows = category_codes(readers.read_csv(spark, csv, TRANSACTIONS), "StateHoliday", "StateHolidayCode")
    writers.write_monthly(rows, "Date", path)


def with_store_attributes(spark: SparkSession, sales: DataFrame, layout: Layout) -> DataFrame:
    """Sales, as a table or a stream, joined with states and store attributes."""
    states = readers.read_csv(spark, layout.states_csv, STORE_STATES)
    stores = readers.read_csv(spark, layout.stores_csv, STORES)
    return enrich(sales, (states, "Store"), (stores, "Store"))


def ingest(spark: SparkSession, layout: Layout, *, every: str | None = None, files_per_batch: int | None = None):
    """Landing files to the bronze table; returns the running query."""
    writers.create_database(spark, layout.database, f"{layout.root}/tables")
    landing = readers.stream_parquet(spark, layout.landing, TRANSACTIONS, files_per_batch=files_per_batch)
    enriched = with_store_attributes(spark, landing, layout)
    return append_to_table(enriched, layout.bronze, layout.checkpoint("bronze"), every=every)


BUCKETS = 16  # of silver: an upsert rewrites only the buckets of its stores


def silver_table(spark: SparkSession, layout: Layout, *, buckets: int = BUCKETS) -> VersionedTable:
    return VersionedTable.create(
        spark, layout.silver, SILVER, bucket_by="Store" if buckets else (), buckets=buckets
    )


def merge(
    spark: SparkSession, layout: Layout, *, every: str | None = None, buckets: int = BUCKETS, on_match: str = "replace"
):
    """Bronze to the newest row per store in silver; returns the running query.

    Store types are letters in the source and numbers in silver: what is not a
    number becomes NULL. Columns silver has gained since keep their values.
    """
    return start_upsert(
        readers.stream_table(spark, layout.bronze),
        silver_table(spark, layout, buckets=buckets),
        "Store",
        "Date",
        layout.checkpoint("silver"),
        every=every,
        tie_break=["Sales", "Customers"],
        on_match=on_match,
        cast="null",
        missing="keep",
    )


def silver_profile(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(NULLs per column, correlations of the numeric columns)."""
    return null_counts(silver), correlation_matrix(silver.drop("StoreType"))


def clean(silver: VersionedTable) -> int:
    """Drop stores without a competition date, fill the promotion week; returns the clean version."""
    silver.delete("CompetitionOpenSinceMonth is null")
    return silver.update({"Promo2SinceWeek": 0}, "Promo2SinceWeek is null")


def append_sales_per_customer(silver: VersionedTable) -> int:
    """Append the table to itself with one more column and without the store type."""
    now = silver.read().drop("StoreType")
    return silver.append(
        now.withColumn("SalesPerCustomer", safe_ratio("Sales", "Customers")), merge_schema=True
    )


def refresh_sales_per_customer(silver: VersionedTable) -> int:
    """Set the ratio of every row where it is not that of its sales and customers: merges change those."""
    ratio = safe_ratio("Sales", "Customers")
    return silver.update({"SalesPerCustomer": ratio}, ~F.col("SalesPerCustomer").eqNullSafe(ratio))


def score_records(spark: SparkSession, layout: Layout, path: str, version: int, *, name: str = "sales") -> DataFrame:
    """Predictions for JSON records of the features, by a stored version of the model."""
    model = regression.load_model(spark, f"{layout.root}/models", name, version)
    return regression.score(model, readers.read_json_records(spark, path, SCORING_RECORD))


def train_and_score(
    spark: SparkSession, layout: Layout, features: DataFrame, *, name: str = "sales", **params
) -> tuple[int, DataFrame]:
    """Split, fit, evaluate, record, store; returns the model version and the gold rows."""
    rows = features.na.fill(0)
    train_rows, test_rows = hash_split(rows, *FEATURES)
    model = regression.train(train_rows, FEATURES, LABEL, **params)
    metrics = regression.evaluate(model, test_rows, LABEL).first().asDict()
    regression.record_run(
        spark, f"{layout.root}/runs", {**regression.DEFAULTS, **params}, metrics,
        started_at=dt.datetime.now(dt.timezone.utc),
    )
    version = regression.save_model(spark, model, f"{layout.root}/models", name)
    gold = regression.gold_table(model, test_rows, FEATURES, LABEL, actual="Real_Sales")
    return version, gold


def publish_gold(gold: DataFrame, layout: Layout) -> None:
    writers.overwrite_table(gold, layout.gold)
    writers.overwrite_path(gold, f"{layout.root}/gold")


def run_once(
    spark: SparkSession, layout: Layout, *, buckets: int = BUCKETS, on_match: str = "replace", **params
) -> VersionedTable:
    """The whole job over the files there are now; a later run picks up only new files."""
    ingest(spark, layout).awaitTermination()
    merge(spark, layout, buckets=buckets, on_match=on_match).awaitTermination()
    silver = silver_table(spark, layout)
    version = clean(silver)
    if "SalesPerCustomer" not in silver.read().columns:
        append_sales_per_customer(silver)
    else:
        refresh_sales_per_customer(silver)
    # Once appended to itself silver has every store twice, with equal features.
    ml = silver.read(version=version).select(*FEATURES, LABEL).distinct()
    writers.overwrite_table(ml, f"{layout.database}.silver_ml", path=f"{layout.root}/silver_ml")
    _, gold = train_and_score(spark, layout, spark.table(f"{layout.database}.silver_ml"), **params)
    publish_gold(gold, layout)
    return silver
