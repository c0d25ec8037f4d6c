"""Boosting by rounds of single trees: penalised leaves, patience, the best round, and a record of every round.

A round fits one Spark ML tree to the residuals, which gives the splits. The
values of its leaves come from one aggregate by leaf: with the sum G of the
residuals of a leaf and its number of rows H, the value is
``soft(G, l1) / (H + l2)``, where ``soft`` moves G towards 0 by l1. The next residuals
follow from that, and so do the losses of both parts, as the same aggregate adds up the
squares. Rows never leave the executors; the driver sees two rows per leaf a round.

Rounds go over cells (see cells.py): rows whose features fall into the same bins. All sums
are those of the rows.

A part of the rows is held back. Fitting ends after ``patience`` rounds without
a gain there, and the model is cut to the rounds up to the best one. A gain is a
loss less than the best so far by more than ``tolerance`` of it (0: any less).
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from itertools import count
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.functions.scalars import truncate_to_int
from salespipe.model import cells
from salespipe.session import ensure_checkpoint_dir
from salespipe.sources import storage

VECTOR, LEAF, FITTED, RESIDUAL, HELD = "__features", "__leaf", "__fitted", "__residual", "__held"

# Fixed values of the job this follows, as far as trees of Spark have them; depth is explained in regression.py.
ROUNDS, PATIENCE, STEP, L1, L2, DEPTH = 1000, 10, 0.4, 0.15, 0.2, 8
BINS = 64  # of a feature in all rounds; Spark gives a tree 32, other ones in each round
CHECKPOINT_ROUNDS = 5
PARTITION_ROWS = 250_000
UNEVEN = 2  # times its share of the rows that a part may have
STORED_AT_ONCE = 8
CURVE_SCHEMA = "round int, train_loss double, held_loss double"
LEAF_SCHEMA = "round int, leaf int, rows long, residuals double, value double"


def leaf_value(residuals: Column, rows: Column, l1: float, l2: float) -> Column:
    """The step of a leaf that minimises squared error under both penalties."""
    return F.signum(residuals) * F.greatest(F.abs(residuals) - l1, F.lit(0.0)) / (rows + l2)


@dataclass
class Boosted:
    """A fitted ensemble: trees, the value of each of their leaves, and how the fit went."""

    features: list[str]
    start: float
    step: float
    trees: list[DecisionTreeRegressionModel]
    values: list[dict[int, float]]
    curve: list[tuple[int, float, float]]
    leaves: list[tuple[int, int, int, float, float]]

    @property
    def best_round(self) -> int:
        return len(self.trees)

    def predict(self, df: DataFrame, prediction: str = "prediction", *, as_int: bool = False) -> DataFrame:
        """Add the prediction next to the row it belongs to."""
        found = self._function()(*[F.col(f"`{f}`").cast("double") for f in self.features])
        value = truncate_to_int(found) if as_int else found
        return df.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(prediction))

    def _function(self) -> Callable[..., Column]:
        """The sum of all trees as one function of the features, of whole batches: an expression of so many trees is too long to compile."""
        start, step, trees = self.start, self.step, [_nodes(t, v) for t, v in zip(self.trees, self.values, strict=True)]

        @F.pandas_udf("double")
        def run(*columns: pd.Series) -> pd.Series:
            x = np.array([c.to_numpy(np.float64) for c in columns])
            if np.isnan(x).any():
                raise ValueError("a feature is NULL or NaN")
            total, row = np.full(x.shape[1], start), np.arange(x.shape[1])
            for depth, feature, border, left, right, value in trees:
                at = np.zeros(x.shape[1], np.int64)
                for _ in range(depth):
                    at = np.where(x[feature[at], row] <= border[at], left[at], right[at])
                total = total + step * value[at]
            return pd.Series(total)

        return run

    def loss_curve(self, spark: SparkSession) -> DataFrame:
        """One row per round fitted, those after the best one too."""
        return spark.createDataFrame(self.curve, CURVE_SCHEMA)

    def leaf_table(self, spark: SparkSession) -> DataFrame:
        """Every leaf of every round: its rows, the sum of their residuals, and its value."""
        return spark.createDataFrame(self.leaves, LEAF_SCHEMA)

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): each tree's gain by feature, averaged over the trees that split at all; sums to 1."""
        total = [0.0] * len(self.features)
        for tree in self.trees:
            for i, gain in enumerate(tree.featureImportances.toArray()):
                total[i] += float(gain)
        whole = sum(total) or 1.0
        return spark.createDataFrame([(f, t / whole) for f, t in zip(self.features, total, strict=True)], "feature string, importance double")

    def save(self, spark: SparkSession, path: str) -> None:
        if self.trees:
            _together(self.trees).write().save(f"{path}/ensemble")
        self.loss_curve(spark).coalesce(1).write.parquet(f"{path}/curve")
        self.leaf_table(spark).coalesce(1).write.parquet(f"{path}/leaves")
        # Written last: without it there is no model.
        facts = {"features": self.features, "start": self.start, "step": self.step, "rounds": self.best_round}
        storage.write_text_once(spark, f"{path}/model.json", json.dumps(facts))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        facts = json.loads(storage.read_text(spark, f"{path}/model.json"))
        if not facts["rounds"]:
            trees = []
        elif storage.exists(spark, f"{path}/ensemble"):
            # Trees of an ensemble forget their columns.
            whole = GBTRegressionModel.load(f"{path}/ensemble")
            trees = [t.copy().setFeaturesCol(VECTOR).setLeafCol(LEAF) for t in whole.trees]
        else:
            # Stored before the trees lay in one table.
            trees = _at_once(lambda i: DecisionTreeRegressionModel.load(_tree_path(path, i)), facts["rounds"])
        curve = [tuple(r) for r in spark.read.schema(CURVE_SCHEMA).parquet(f"{path}/curve").sort("round").collect()]
        leaves = [tuple(r) for r in spark.read.schema(LEAF_SCHEMA).parquet(f"{path}/leaves").sort("round", "leaf").collect()]
        values = [{leaf: v for n, leaf, _, _, v in leaves if n == i + 1} for i in range(facts["rounds"])]
        return cls(facts["features"], facts["start"], facts["step"], trees, values, curve, leaves)


def _tree_path(path: str, i: int) -> str:
    return f"{path}/trees/{i:06d}"


def _at_once(run: Callable[[int], object], n: int) -> list:
    """``run`` of 0 to n - 1, several at a time: loading a tree takes a few jobs of one task each."""
    with ThreadPool(STORED_AT_ONCE) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(run), range(n))


def _nodes(tree: DecisionTreeRegressionModel, values: dict[int, float]) -> tuple:
    """Depth, and of each node: feature, threshold, children and value. Leaves are numbered from the left; each is its own child."""
    lines = iter(line.strip() for line in tree.toDebugString.splitlines()[1:])
    feature, border, left, right, value, depths, leaf = [], [], [], [], [], [0], count()

    def read(depth: int) -> int:
        line, at = next(lines), len(feature)
        for column, first in ((feature, 0), (border, math.inf), (left, at), (right, at), (value, 0.0)):
            column.append(first)
        if split := re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line):
            feature[at], border[at] = int(split[1]), float(split[2])
            left[at] = read(depth + 1)
            next(lines)  # Else
            right[at] = read(depth + 1)
        else:
            depths.append(depth)
            value[at] = values.get(next(leaf), 0.0)
        return at

    read(0)
    return max(depths), np.array(feature), np.array(border), np.array(left), np.array(right), np.array(value)


def _together(trees: list[DecisionTreeRegressionModel]) -> GBTRegressionModel:
    """The trees as one model of Spark, which is stored at once."""
    context = SparkSession.active().sparkContext
    single = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    listed, weights = context._gateway.new_array(single, len(trees)), context._gateway.new_array(context._jvm.double, len(trees))
    for i, tree in enumerate(trees):
        listed[i], weights[i] = tree._java_obj, 1.0
    ensemble = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"boosted_{uuid.uuid4().hex}", listed, weights)
    return GBTRegressionModel._from_java(ensemble)


def spread(df: DataFrame) -> DataFrame:
    """The rows as they are if their parts are even enough to keep all cores at work, else ``dealt``."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    most, rows = parts.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return df if most * cores <= UNEVEN * rows else dealt(df, rows)


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """The rows over all cores, however few parts they come in, and in parts of bounded size."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-rows // (cores * PARTITION_ROWS))))


def _placed(tree: DecisionTreeRegressionModel, df: DataFrame) -> DataFrame:
    """Add the leaf of each row; the tree's own prediction is of no use here."""
    return tree.copy().setPredictionCol("").transform(df)


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=VECTOR).transform(df)


def _lookup(values: dict[int, float]) -> Column:
    """The value of a row's leaf, from an array with a place for each leaf of the tree."""
    listed = F.array(*[F.lit(float(values.get(i, 0.0))) for i in range(max(values, default=0) + 1)])
    return F.coalesce(F.get(listed, F.col(LEAF).cast("int")), F.lit(0.0))


def leaf_ids(tree: DecisionTreeRegressionModel, df: DataFrame, features: list[str]) -> DataFrame:
    """Add the ``leaf`` of a tree that each row falls into."""
    placed = _placed(tree, _assembled(df, features))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], F.col(LEAF).cast("int").alias("leaf"))


def held_back(keys: list, percent: int = 20) -> Column:
    """Whether a row is held back from the fit, by a hash of its key that no train/test split uses."""
    return F.pmod(F.xxhash64(*keys), F.lit(100)) < percent


def _loss(sums: list, values: dict[int, float], step: float) -> float | None:
    """The mean square error of a part once its leaves have moved, from the count, sum and squares of each leaf's residuals."""
    n = sum(r["known"] for r in sums)
    if not n:
        return None
    moved = [(r, step * values.get(r["leaf"], 0.0)) for r in sums if r["known"]]
    return max(math.fsum(r["squares"] - 2 * by * r["residuals"] + r["known"] * by * by for r, by in moved) / n, 0.0)


def fit(
    rows: DataFrame,
    features: list[str],
    label: str,
    *,
    held_key: Column | str | list | None = None,
    held_percent: int = 20,
    rounds: int = ROUNDS,
    patience: int = PATIENCE,
    tolerance: float = 0.0,
    step: float = STEP,
    l1: float = L1,
    l2: float = L2,
    depth: int = DEPTH,
    seed: int = 42,
) -> Boosted:
    """Fit on the rows without ``held_percent`` of them, chosen by a hash of ``held_key`` (default: the features)."""
    ensure_checkpoint_dir(rows.sparkSession)
    keys = held_key if isinstance(held_key, list) else [held_key] if held_key is not None else features
    held = held_back(keys, held_percent)
    known = rows.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features], F.col(label).cast("double").alias(label), held.alias(HELD))
    fitted = ~F.col(HELD)
    start, n, *around = known.agg(
        F.avg(F.when(fitted, F.col(label))), F.count_if(fitted), *[cells.quantiles(f, BINS, fitted) for f in features]
    ).first()
    if not n:
        raise ValueError("there are no rows to fit on")
    summed = cells.cells(known, dict(zip(features, around, strict=True)), label, HELD).persist(StorageLevel.MEMORY_AND_DISK)
    total = summed.count()
    # Every round reads the cells many times; the vector alone goes on.
    now = dealt(_assembled(summed, features).select(VECTOR, HELD, *cells.SUMMARY), total).withColumn(FITTED, F.lit(start))
    now = now.persist(StorageLevel.MEMORY_AND_DISK)
    kept: list[DataFrame] = [now]
    trees, values, curve, leaves = [], [], [], []
    best, best_loss = 0, None
    try:
        while len(trees) < rounds and len(trees) - best < patience:
            number = len(trees) + 1
            residual = now.withColumn(RESIDUAL, F.col(cells.MEAN) - F.col(FITTED))
            tree = DecisionTreeRegressor(
                featuresCol=VECTOR, labelCol=RESIDUAL, predictionCol="__tree", leafCol=LEAF, maxDepth=depth, seed=seed + number,
                weightCol=cells.ROWS, maxBins=cells.bins_of_trees(BINS, total),
            ).fit(residual.filter(fitted))
            placed = _placed(tree, residual)
            # One pass gives the leaves and, as a leaf moves all its rows by one value, the losses after the round too.
            sums = placed.groupBy(F.col(LEAF).cast("int").alias("leaf"), HELD).agg(
                F.sum(cells.ROWS).alias("rows"), F.sum(cells.KNOWN).alias("known"), F.sum(F.col(cells.KNOWN) * F.col(RESIDUAL)).alias("residuals"),
                F.sum(F.col(cells.SPREAD) + F.col(cells.KNOWN) * F.col(RESIDUAL) * F.col(RESIDUAL)).alias("squares"),
            )
            found = sums.withColumn("value", leaf_value(F.col("residuals"), F.col("rows"), l1, l2)).collect()
            # That pass has read, and so kept, all rows of this round: those they were made of can go.
            while len(kept) > 1:
                kept.pop(0).unpersist()
            own = {r["leaf"]: r["value"] for r in found if not r[HELD]}
            train_loss, held_loss = (_loss([r for r in found if r[HELD] == part], own, step) for part in (False, True))
            trees.append(tree)
            values.append(own)
            own_leaves = sorted((r for r in found if not r[HELD]), key=lambda r: r["leaf"])
            leaves += [(number, r["leaf"], r["rows"], r["residuals"], r["value"]) for r in own_leaves]
            # Without held-back rows there is nothing to wait for: the fitted rows stand in.
            held_loss = held_loss if held_loss is not None else train_loss
            curve.append((number, train_loss, held_loss))
            if best_loss is None or held_loss < best_loss * (1 - tolerance):
                best, best_loss = number, held_loss
            # The rows of a round are kept while the next is made of them; their lineage is cut every few rounds.
            now = placed.withColumn(FITTED, F.col(FITTED) + step * _lookup(own)).select(VECTOR, HELD, *cells.SUMMARY, FITTED)
            now = now.checkpoint() if number % CHECKPOINT_ROUNDS == 0 else now
            now = now.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(now)
    finally:
        for df in kept:
            df.unpersist()
    return Boosted(features, start, step, trees[:best], values[:best], curve, leaves)
