"""Boosting by single trees: leaves, patience, the best round, the record, storage."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from salespipe.model import boosting
from salespipe.sources import storage

SETTINGS = {"depth": 3, "patience": 4, "tolerance": 0.1}


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    rows = [(i, float(rng.randrange(20)), rng.random(), rng.random()) for i in range(1500)]
    rows = [(i, a, b, c, 3 * a + (10 if b > 0.5 else 0) + rng.gauss(0, 1)) for i, a, b, c in rows]
    return spark.createDataFrame(rows, "id long, a double, b double, noise double, y double").repartition(3).cache()


@pytest.fixture(scope="module")
def model(data):
    return boosting.fit(data, ["a", "b", "noise"], "y", held_key="id", **SETTINGS)


def test_it_ends_by_patience_and_is_cut_to_its_best_round(spark, data, model):
    curve = [r.held_loss for r in model.loss_curve(spark).sort("round").collect()]
    assert len(curve) == model.best_round + 4 == len(model.trees) + 4
    best = curve[model.best_round - 1]
    assert all(later >= best * 0.9 for later in curve[model.best_round :])
    held = data.filter(boosting.held_back(["id"]))
    error = model.predict(held).agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0]
    assert error == pytest.approx(best, rel=1e-9)


def test_leaves_have_the_value_of_their_closed_form(spark, data, model):
    first = boosting.leaf_ids(model.trees[0], data.filter(~boosting.held_back(["id"])), model.features)
    sums = {r.leaf: (r.n, r.g) for r in first.groupBy("leaf").agg(F.count("y").alias("n"), F.sum(F.col("y") - model.start).alias("g")).collect()}
    leaves = model.leaf_table(spark).filter("round = 1").collect()
    assert len(leaves) == len(sums) > 2
    for r in leaves:
        n, g = sums[r.leaf]
        assert r.rows == n and r.residuals == pytest.approx(g)
        assert r.value == pytest.approx((1 if g > 0 else -1) * max(abs(g) - boosting.L1, 0) / (n + boosting.L2))


def test_penalties_shrink_leaves(spark, data):
    heavy = boosting.fit(data, ["a", "b"], "y", held_key="id", rounds=1, l1=1e9, depth=2)
    assert {r.value for r in heavy.leaf_table(spark).collect()} == {0.0}
    ridge = boosting.fit(data, ["a", "b"], "y", held_key="id", rounds=1, l1=0, l2=1e6, depth=2)
    assert max(abs(r.value) for r in ridge.leaf_table(spark).collect()) < 0.1


def test_importances_name_the_features_that_matter(spark, model):
    found = {r.feature: r.importance for r in model.importances(spark).collect()}
    assert sum(found.values()) == pytest.approx(1) and found["a"] > found["noise"] and found["b"] > found["noise"]


def test_a_stored_model_predicts_as_the_fitted_one(spark, data, model, tmp_path):
    model.save(spark, f"{tmp_path}/m")
    stored = boosting.Boosted.load(spark, f"{tmp_path}/m")
    both = stored.predict(model.predict(data, "p", as_int=True), "q", as_int=True)
    assert both.filter("p <> q").count() == 0 and both.schema["q"].dataType.simpleString() == "int"
    assert stored.loss_curve(spark).count() == model.loss_curve(spark).count()


def test_small_tables(spark):
    one = spark.createDataFrame([(1, 2.0, 5.0)], "id long, a double, y double")
    fitted = boosting.fit(one, ["a"], "y", held_key="id", held_percent=0, rounds=3)
    assert fitted.predict(one).first().prediction == pytest.approx(5.0)
    with pytest.raises(ValueError):
        boosting.fit(one.limit(0), ["a"], "y", held_key="id")


def test_rows_of_one_part_are_fitted_in_many(spark, data, monkeypatch):
    seen, fit = [], boosting.DecisionTreeRegressor.fit

    def watched(self, rows, *more):
        seen.append((rows.rdd.getNumPartitions(), rows.rdd.glom().map(len).collect()))
        return fit(self, rows, *more)

    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", watched)
    boosting.fit(data.coalesce(1), ["a", "b"], "y", held_key="id", rounds=2, depth=2)
    assert len(seen) == 2
    for parts, sizes in seen:
        assert parts == spark.sparkContext.defaultParallelism and min(sizes) > 0


def test_parts_have_a_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    assert boosting.dealt(spark.range(1), cores * 10 + 1).rdd.getNumPartitions() == 2 * cores
    assert boosting.dealt(spark.range(1), 0).rdd.getNumPartitions() == cores


def test_losses_of_the_record_are_those_of_the_rows(spark, data):
    fitted = boosting.fit(data, ["a", "b"], "y", held_key="id", rounds=7, depth=2)
    for number, train, held in fitted.curve:
        cut = boosting.Boosted(fitted.features, fitted.start, fitted.step, fitted.trees[:number], fitted.values[:number], [], [])
        error = F.pow(F.col("y") - F.col("p"), 2)
        apart = boosting.held_back(["id"])
        found = cut.predict(data, "p").agg(F.avg(F.when(~apart, error)), F.avg(F.when(apart, error))).first()
        assert (train, held) == pytest.approx(tuple(found), rel=1e-9)


def test_rounds_go_over_cells_however_often_rows_repeat(spark, data, monkeypatch):
    seen, fit = [], boosting.DecisionTreeRegressor.fit

    def watched(self, rows, *more):
        seen.append((rows.count(), rows.agg(F.sum("__rows")).first()[0]))
        return fit(self, rows, *more)

    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", watched)
    monkeypatch.setattr(boosting, "BINS", 8)
    own = (F.col("id") + 10_000 * F.col("copy")).alias("id")
    spread = data.crossJoin(spark.range(20).toDF("copy")).select(own, (F.col("a") + F.col("copy") / 20).alias("a"), "b", "y").cache()
    fitted = boosting.fit(spread, ["a", "b"], "y", held_key="id", rounds=3, depth=3)
    taught = spread.filter(~boosting.held_back(["id"]))
    assert [rows for _, rows in seen] == [taught.count()] * 3 and all(n <= 8 * 8 for n, _ in seen)
    for number in (1, 3):
        earlier = boosting.Boosted(fitted.features, fitted.start, fitted.step, fitted.trees[: number - 1], fitted.values[: number - 1], [], [])
        placed = boosting.leaf_ids(fitted.trees[number - 1], earlier.predict(taught, "p"), fitted.features)
        sums = {r.leaf: (r.n, r.g) for r in placed.groupBy("leaf").agg(F.count("y").alias("n"), F.sum(F.col("y") - F.col("p")).alias("g")).collect()}
        stated = {r.leaf: (r.rows, r.residuals) for r in fitted.leaf_table(spark).filter(F.col("round") == number).collect()}
        assert stated.keys() == sums.keys()
        for leaf, (n, g) in sums.items():
            assert stated[leaf][0] == n and stated[leaf][1] == pytest.approx(g, rel=1e-6, abs=1e-6)


def test_an_unknown_feature_or_label_is_refused(spark, data, model):
    odd = data.limit(20).withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a")))
    with pytest.raises(Exception, match="NULL or NaN"):
        model.predict(odd).collect()
    with pytest.raises(Exception):
        boosting.fit(odd, ["a", "b"], "y", held_key="id", held_percent=0, rounds=1)
    with pytest.raises(Exception):
        boosting.fit(data.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), ["a"], "y", held_key="id", held_percent=0, rounds=1)


def test_trees_stored_one_by_one_are_still_read(spark, data, model, tmp_path):
    model.save(spark, f"{tmp_path}/m")
    old = [tree.write().overwrite().save(boosting._tree_path(f"{tmp_path}/m", i)) for i, tree in enumerate(model.trees)]
    storage.delete_folder(spark, f"{tmp_path}/m/ensemble")
    both = boosting.Boosted.load(spark, f"{tmp_path}/m").predict(model.predict(data, "p"), "q")
    assert len(old) == model.best_round and both.filter("p <> q").count() == 0
