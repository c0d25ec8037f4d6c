"""Boosted-tree regression: features, training, metrics, scoring and versions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.functions.scalars import truncate_to_int
from salespipe.model import boosting, cells
from salespipe.operators.profile import regression_metrics
from salespipe.session import ensure_checkpoint_dir
from salespipe.sources import storage

FEATURE_VECTOR = "features"
RAW_PREDICTION = "raw_prediction"
HELD_OUT = "held_out"
BINS = 32  # of a feature, as Spark has it
RUN_SCHEMA = "run_id string, started_at timestamp, params map<string,string>, metrics map<string,double>"

# Up to a thousand rounds; early stopping ends the fit. Each level of a tree is a
# pass over the rows and doubles the nodes, so depth is kept at 8: deeper trees
# cost in proportion and soon hold single rows. Spark allows up to 30.
DEFAULTS = {"stepSize": 0.4, "maxDepth": 8, "maxIter": 1000, "minInstancesPerNode": 1, "lossType": "squared", "seed": 42}


def feature_table(df: DataFrame, features: list[str], label: str, *extra: str) -> DataFrame:
    """Feature and label columns only, NULL numbers as 0."""
    names = list(dict.fromkeys([*extra, *features, label]))
    return df.select(*names).na.fill(0)


def train(
    train_rows: DataFrame,
    features: list[str],
    label: str,
    *,
    split_key: str | Column | list | None = None,
    stop_early: bool = True,
    tolerance: float = 0.01,
    partitions: int | None = None,
    **params,
) -> PipelineModel:
    """Fit assembler and trees as one pipeline; all rows stay in Spark.

    Early stopping watches a fifth of the training rows, chosen by a hash of
    ``split_key`` (default: of the features), so the test rows stay unseen.
    Fitting stops at the first round that improves the loss there by less than
    ``tolerance`` (relative), which is Spark's rule, without patience.

    With Spark's settings for squared error the rows go in as cells (see cells.py), which give the trees the rows
    would give; else as they are. Rows stay in the partitions they are read in; ``partitions`` spreads them anew.
    """
    ensure_checkpoint_dir(train_rows.sparkSession)
    settings = {**DEFAULTS, **params}
    needed = [*features, label]
    rows = train_rows
    if stop_early:
        keys = split_key if isinstance(split_key, list) else [split_key] if split_key is not None else features
        # Not the hash of the train/test draw, so the two draws are independent.
        rows = rows.withColumn(HELD_OUT, F.pmod(F.xxhash64(*keys), F.lit(100)) < 20)
        settings.update(validationIndicatorCol=HELD_OUT, validationTol=tolerance)
        needed.append(HELD_OUT)
    rows = rows.select(*needed)
    if celled := _fits_cells(rows, features, settings):
        rows, n = _cells(rows, features, label, settings.get("maxBins", BINS), stop_early, partitions)
        settings.update(weightCol=cells.ROWS, maxBins=cells.bins_of_trees(settings.get("maxBins", BINS), n))
    elif partitions:
        rows = rows.repartition(partitions)
    trees = GBTRegressor(
        featuresCol=FEATURE_VECTOR, labelCol=label, predictionCol=RAW_PREDICTION, checkpointInterval=10, **settings
    )
    assemble = VectorAssembler(inputCols=features, outputCol=FEATURE_VECTOR)
    # Fitting reads the rows several times before it keeps its own binned copy.
    rows = rows if celled else rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assemble, trees]).fit(rows)
    finally:
        rows.unpersist()


def _fits_cells(rows: DataFrame, features: list[str], settings: dict) -> bool:
    """Whether cells stand for the rows: only sums of labels and squares are asked, of numbers, and no row counts by itself."""
    plain = {"lossType": "squared", "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0}
    numbers = all(isinstance(rows.schema[f].dataType, T.NumericType | T.BooleanType) for f in features)
    return numbers and "weightCol" not in settings and all(settings.get(k, v) == v for k, v in plain.items())


def _cells(rows: DataFrame, features: list[str], label: str, bins: int, apart: bool, partitions: int | None) -> tuple[DataFrame, int]:
    """The cells of the rows, kept, with a weight each; how many there are.

    A held-out cell comes as two halves, the spread of its labels apart, so that the loss there is that of its rows.
    """
    by = [HELD_OUT] if apart else []
    rows = rows.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features], F.col(f"`{label}`").cast("double").alias(label), *by)
    taught = ~F.col(HELD_OUT) if apart else F.lit(True)
    around = rows.agg(*[cells.quantiles(f, bins, taught) for f in features]).first()
    found = cells.cells(rows, dict(zip(features, around, strict=True)), label, *by)
    weight, mean = F.col(cells.ROWS).cast("double"), F.col(cells.MEAN)
    off = F.sqrt(F.col(cells.SPREAD) / F.col(cells.KNOWN))
    whole = F.array(F.struct(mean.alias(label), weight.alias(cells.ROWS)))
    halves = F.array(*[F.struct((mean + sign * off).alias(label), (weight / 2).alias(cells.ROWS)) for sign in (-1, 1)])
    parts = F.when(F.col(HELD_OUT) & (off > 0), halves).otherwise(whole) if apart else whole
    found = found.select(*[F.col(f"`{f}`") for f in features], *by, F.inline(parts)).persist(StorageLevel.MEMORY_AND_DISK)
    n = found.count()
    kept = (found.repartition(partitions) if partitions else boosting.dealt(found, n)).persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    found.unpersist()
    return kept, n


def rounds(model: PipelineModel) -> int:
    """How many rounds of boosting the fit took."""
    return model.stages[-1].getNumTrees


def score(model: PipelineModel, df: DataFrame, prediction: str = "prediction", *, as_int: bool = True) -> DataFrame:
    """Add the prediction next to the row it belongs to, cut to an integer by default."""
    raw = F.col(RAW_PREDICTION)
    value = truncate_to_int(raw) if as_int else raw
    return model.transform(df).select(*df.columns, value.alias(prediction))


def model_udf(
    load: Callable[[], Callable[[pd.DataFrame], object]], features: list[str], returns: str = "double"
) -> Column:
    """A model from outside Spark ML as a column.

    ``load`` runs once per task and returns the predictor; Arrow batches of the
    features go to that, and it returns one number per row.
    """

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = load()
        for batch in batches:
            yield pd.Series(predict(batch))

    return run(F.struct(*features))


def evaluate(model: PipelineModel, test_rows: DataFrame, label: str) -> DataFrame:
    """One row of (n, mae, mse, r2, loss); loss is -r2, the quantity to minimise."""
    scored = score(model, test_rows, RAW_PREDICTION, as_int=False)
    metrics = regression_metrics(scored, label, RAW_PREDICTION)
    return metrics.withColumn("loss", -F.col("r2"))


def gold_table(
    model: PipelineModel, test_rows: DataFrame, features: list[str], label: str, *, actual: str, extra: tuple = ()
) -> DataFrame:
    """Features, integer prediction and actual value of each row."""
    scored = score(model, test_rows)
    return scored.select(*extra, *features, "prediction", F.col(label).alias(actual))


# ------------------------------------------------------------ runs, versions


def record_run(
    spark: SparkSession, path: str, params: dict, metrics: dict, *, started_at: dt.datetime | None = None
) -> str:
    """Append one training run to the table of runs; returns its id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        started_at or dt.datetime.now(dt.timezone.utc),
        {k: str(v) for k, v in params.items()},
        {k: None if v is None else float(v) for k, v in metrics.items()},
    )
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def model_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    return sorted(int(n) for n in storage.list_names(spark, f"{root}/{name}") if n.isdigit())


def save_model(spark: SparkSession, model: PipelineModel, root: str, name: str) -> int:
    """Store a model as the next version under its name."""
    version = max(model_versions(spark, root, name), default=0) + 1
    model.write().save(f"{root}/{name}/{version}")
    return version


def load_model(spark: SparkSession, root: str, name: str, version: int) -> PipelineModel:
    if version not in model_versions(spark, root, name):
        raise ValueError(f"no version {version} of model {name}")
    return PipelineModel.load(f"{root}/{name}/{version}")
