"""The whole job on generated files, and the model operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salespipe.model import regression
from salespipe.plans import retail
from salespipe.sources import readers, writers

FAST = {"maxDepth": 4, "maxIter": 8}


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("retail"))
    days = spark.sql(
        """
        select s.id as Store, dayofweek(d) as DayOfWeek, cast(d as timestamp) as Date,
               (500 + s.id * 7 + dayofweek(d) * 40) * cast(dayofweek(d) <> 1 as int) as Sales,
               (50 + s.id % 9) * cast(dayofweek(d) <> 1 as int) as Customers,
               cast(dayofweek(d) <> 1 as int) as Open, s.id % 2 as Promo,
               case when s.id % 5 = 0 then 'a' else '0' end as StateHoliday, 0 as SchoolHoliday
        from range(1, 121) s lateral view explode(sequence(date'2015-01-01', date'2015-03-01', interval 1 day)) as d
        """
    )
    days.write.option("header", True).csv(f"{root}/train")
    spark.range(1, 121).selectExpr(
        "id as Store", "concat('S', id % 4) as State", "48.0 + id % 4 as Latitude", "11.5 as Longitude",
    ).write.option("header", True).csv(f"{root}/states")
    spark.range(1, 116).selectExpr(
        "id as Store", "case when id % 3 = 0 then '7' else 'c' end as StoreType", "'a' as Assortment",
        "id * 10 as CompetitionDistance", "case when id % 4 > 0 then id % 12 + 1 end as CompetitionOpenSinceMonth",
        "2010 as CompetitionOpenSinceYear", "id % 2 as Promo2", "case when id % 2 = 1 then 14 end as Promo2SinceWeek",
        "case when id % 2 = 1 then 2012 end as Promo2SinceYear", "'Jan,Apr' as PromoInterval",
    ).write.option("header", True).csv(f"{root}/stores")
    found = retail.Layout(f"{root}/landing", f"{root}/states", f"{root}/stores", f"{root}/run", "retail_test")
    retail.land_csv(spark, f"{root}/train", found.landing, files=4)
    retail.land_monthly(spark, f"{root}/train", f"{root}/monthly")
    yield found
    spark.sql("DROP DATABASE IF EXISTS retail_test CASCADE")


def test_the_job_from_files_to_gold(spark, layout):
    silver = retail.run_once(spark, layout, **FAST)
    bronze = spark.table(layout.bronze)
    assert len(bronze.columns) == 21 and bronze.count() == 115 * 60
    merged = silver.read(version=1)
    assert merged.count() == 115 and [f.simpleString() for f in merged.schema][0] == "Store:int"
    types = merged.groupBy("StoreType").count().collect()
    assert {r.StoreType for r in types} == {7, None}
    log = [r.operation for r in silver.history().orderBy("version").collect()]
    assert log == ["CREATE TABLE"] + ["MERGE", "DELETE", "UPDATE", "APPEND"]
    clean = silver.read(version=3)
    assert clean.filter("CompetitionOpenSinceMonth is null or Promo2SinceWeek is null").count() == 0
    assert silver.read().count() == 2 * clean.count() and len(silver.read().columns) == 22
    gold = spark.table(layout.gold)
    assert gold.columns == [*retail.FEATURES, "prediction", "Real_Sales"]
    assert gold.count() > 0 and spark.read.parquet(f"{layout.root}/gold").count() == gold.count()
    assert gold.filter("Store < 150").count() == gold.count()
    run = regression.runs(spark, f"{layout.root}/runs").first()
    assert set(run.metrics) == {"n", "mae", "mse", "r2", "loss"} and run.params["maxDepth"] == "4"

    nulls, corr = retail.silver_profile(clean)
    assert nulls.count() == 21
    assert corr.count() == 15 * 15

    # Scoring records with a stored model version.
    model = regression.load_model(spark, f"{layout.root}/models", "sales", 1)
    records = f"{layout.root}/records"
    gold.select(F.to_json(F.array(F.struct(*retail.FEATURES))).alias("value")).write.text(records)
    back = retail.score_records(spark, layout, records, 1)
    assert back.count() == gold.count() and dict(back.dtypes)["prediction"] == "int"
    with pytest.raises(ValueError, match="no version 2"):
        regression.load_model(spark, f"{layout.root}/models", "sales", 2)


def test_a_later_run_takes_the_new_files(spark, layout):
    """Runs after the first one above: silver has its extra column and every store twice."""
    before = retail.silver_table(spark, layout)
    first = before.version()
    day = spark.range(1, 11).selectExpr(
        "id as Store", "2L as DayOfWeek", "timestamp'2015-03-02' as Date", "5L as Sales", "1L as Customers", "1L as Open",
        "0L as Promo", "'0' as StateHoliday", "0L as SchoolHoliday",
    )
    day.coalesce(1).write.mode("append").parquet(layout.landing)
    silver = retail.run_once(spark, layout, **FAST)
    log = [r.operation for r in silver.history().filter(f"version > {first}").orderBy("version").collect()]
    assert log == ["MERGE", "DELETE", "UPDATE", "UPDATE"]
    new = silver.read().filter("Date = timestamp'2015-03-02'")
    assert {r["count"] for r in new.groupBy("Store").count().collect()} == {2}
    # The ratio is that of the new figures, in new rows and old.
    assert {r.SalesPerCustomer for r in new.collect()} == {5.0}
    off = "not (SalesPerCustomer <=> try_divide(Sales, nullif(Customers, 0)))"
    assert silver.read().filter(off).count() == 0
    assert regression.model_versions(spark, f"{layout.root}/models", "sales") == [1, 2]
    features = spark.table("retail_test.silver_ml")
    assert features.count() == features.select("Store").distinct().count()


def test_monthly_landing_has_codes(spark, layout):
    monthly = readers.read_parquet(spark, layout.landing.replace("landing", "monthly"))
    assert monthly.select("month").distinct().count() == 3
    assert {tuple(r) for r in monthly.select("StateHoliday", "StateHolidayCode").distinct().collect()} == {("0", 0), ("a", 1)}


def test_batch_and_stream_share_the_join(spark, layout, rows):
    batch = retail.with_store_attributes(
        spark, readers.read_parquet(spark, layout.landing, retail.TRANSACTIONS), layout
    )
    assert batch.exceptAll(spark.table(layout.bronze)).count() == 0
    assert spark.table(layout.bronze).count() == batch.count()


@pytest.fixture(scope="module")
def lines(spark):
    return spark.range(3000).select(
        "id", (F.col("id") % 50).cast("double").alias("q"), (F.col("id") % 7).cast("double").alias("p")
    ).withColumn("y", F.col("q") * F.col("p"))


def test_training_is_repeatable_and_fits(spark, lines):
    scores = []
    for _ in range(2):
        model = regression.train(lines.filter("id % 4 > 0"), ["q", "p"], "y", split_key="id", **FAST)
        scores.append(regression.evaluate(model, lines.filter("id % 4 = 0"), "y").first())
    assert scores[0] == scores[1] and scores[0].r2 > 0.9 and scores[0].loss == -scores[0].r2


def test_models_have_versions(spark, lines, root):
    model = regression.train(lines, ["q", "p"], "y", maxDepth=2, maxIter=2, stop_early=False)
    assert [regression.save_model(spark, model, root, "m") for _ in range(2)] == [1, 2]
    assert regression.model_versions(spark, root, "m") == [1, 2]
    scored = regression.score(regression.load_model(spark, root, "m", 2), lines)
    assert scored.columns == ["id", "q", "p", "y", "prediction"] and scored.count() == 3000


def test_a_fresh_root_replays_everything(spark, layout):
    fresh = retail.Layout(layout.landing, layout.states_csv, layout.stores_csv, f"{layout.root}2", "retail_again")
    try:
        retail.ingest(spark, fresh, files_per_batch=5).awaitTermination()
        bronze = spark.table(fresh.bronze).count()
        assert bronze == 115 * 60 + 10
        retail.ingest(spark, fresh).awaitTermination()
        assert spark.table(fresh.bronze).count() == bronze
        retail.merge(spark, fresh, buckets=4, on_match="if_newer").awaitTermination()
        newest = retail.silver_table(spark, fresh).read()
        assert newest.count() == 115 and newest.filter("Date < timestamp'2015-03-01'").count() == 0
    finally:
        writers.reset(spark, [fresh.bronze], [fresh.root])
        spark.sql("DROP DATABASE retail_again CASCADE")
