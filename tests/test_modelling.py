"""The model queries train with the library's settings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salespipe.model import regression
from salespipe.plans import modelling
from tests.conftest import DATA


def test_model_queries_keep_the_default_depth(spark, monkeypatch):
    given = {}
    monkeypatch.setattr(regression, "train", lambda *args, **params: given.update(params))
    modelling._fitted(spark, DATA)
    assert (regression.DEFAULTS | given)["maxDepth"] == regression.DEFAULTS["maxDepth"]


@pytest.mark.parametrize("early", [True, False])
def test_cells_give_the_trees_of_the_rows(spark, monkeypatch, early):
    # Values few enough that every one has a bin: the rows have the same thresholds.
    rows = spark.range(4000).select(
        "id", (F.col("id") % 17).alias("a"), (F.col("id") * 7 % 23).cast("double").alias("b"), (F.rand(3) * 5 + F.col("id") % 17).alias("y")
    )
    seen, fit = [], regression.Pipeline.fit
    monkeypatch.setattr(regression.Pipeline, "fit", lambda self, df, *more: seen.append(df.count()) or fit(self, df, *more))
    settings = {"maxIter": 30, "maxDepth": 4, "stop_early": early, "split_key": "id"}
    celled = regression.train(rows, ["a", "b"], "y", **settings)
    monkeypatch.setattr(regression, "_fits_cells", lambda *_: False)
    plain = regression.train(rows, ["a", "b"], "y", **settings)
    assert seen[0] <= 17 * 23 * (3 if early else 1) < seen[1] == 4000
    assert regression.rounds(celled) == regression.rounds(plain)
    both = regression.score(celled, regression.score(plain, rows, "p", as_int=False), "q", as_int=False)
    assert both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-6


def test_rows_go_in_as_they_are_where_cells_would_not_do(spark):
    rows = spark.range(3).select(F.col("id").cast("double").alias("a"), F.array("id").alias("b"))
    fits = regression._fits_cells
    assert fits(rows, ["a"], dict(regression.DEFAULTS)) and not fits(rows, ["a", "b"], dict(regression.DEFAULTS))
    for other in ({"lossType": "absolute"}, {"minInstancesPerNode": 5}, {"subsamplingRate": 0.5}, {"weightCol": "a"}):
        assert not fits(rows, ["a"], regression.DEFAULTS | other)
