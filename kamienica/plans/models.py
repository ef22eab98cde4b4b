"""Comparing regression models by cross-validated R², trained by Spark ML on the executors."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kamienica import schema
from kamienica.operators.boosting import AdaBoostR2
from kamienica.operators.extra_trees import ExtraTreesRegressor
from kamienica.operators.kernel import KernelRegressor
from kamienica.operators.neighbours import KNNRegressor
from kamienica.operators.network import NetworkRegressor
from kamienica.operators.scale import with_fold
from kamienica.operators.sgd import SGDRegressor
from kamienica.session import settle

SEED = 123
ROWS_PER_TASK = 50_000
DEEP_EXTRA = 10  # extra trees are held in memory as whole levels
DEEPEST = 30  # the deepest trees Spark grows; the compared models have no limit of their own


def regressors(key: str, seed: int = SEED, trees: int = 100, bags: int = 10, depth: int = DEEPEST,
               rounds: int = 100, boosts: int = 50) -> dict[str, Estimator]:
    """The compared models by their short names."""
    return {
        "LR": LinearRegression(),
        "MLP": NetworkRegressor(keyCol=key, seed=seed),
        "KNN": KNNRegressor(keyCol=key, k=5),
        "SVC": KernelRegressor(keyCol=key, seed=seed),
        "DTC": DecisionTreeRegressor(seed=seed, maxDepth=depth, maxMemoryInMB=512),
        "RF": RandomForestRegressor(seed=seed, numTrees=trees, maxDepth=depth),
        "XGB": GBTRegressor(seed=seed, maxIter=rounds, maxDepth=3, stepSize=0.1),
        "BagR": RandomForestRegressor(seed=seed, numTrees=bags, maxDepth=depth, featureSubsetStrategy="all"),
        "ETR": ExtraTreesRegressor(numTrees=trees, maxDepth=min(depth, DEEP_EXTRA), seed=seed),
        "ABC": AdaBoostR2(rounds=boosts, seed=seed),
        "SGD": SGDRegressor(keyCol=key, seed=seed + 1),  # an order that has nothing to do with the folds
    }


def ridge_regression() -> LinearRegression:
    """The optimum that the stochastic steps of "SGD" go towards."""
    return LinearRegression(regParam=1e-4, elasticNetParam=0.0, solver="l-bfgs")


@dataclass(frozen=True)
class Run:
    """One compared model: its scores over the folds and the model fitted on all training rows."""

    name: str
    mean_r2: float
    std_r2: float
    model: Model


def compare_models(train: DataFrame, estimators: Mapping[str, Estimator], key: str, folds: int = 5,
                   seed: int = SEED, parallelism: int = 2) -> list[Run]:
    """Cross-validate and refit every estimator; a row's fold depends on its key only.

    The rows are written once, dealt over tasks: every fold of every model goes over them many times, and those of a narrow
    table would all come in one split.
    """
    tasks = max(1, math.ceil(train.count() / ROWS_PER_TASK))
    with_folds = settle(with_fold(train, key, folds, seed).repartition(tasks))
    runs = []
    for name, estimator in estimators.items():
        validator = CrossValidator(
            estimator=estimator, estimatorParamMaps=[{}], evaluator=RegressionEvaluator(metricName="r2"),
            numFolds=folds, foldCol="fold", seed=seed, parallelism=parallelism)
        fitted = validator.fit(with_folds)
        runs.append(Run(name, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]), fitted.bestModel))
    return runs


def leaderboard(spark: SparkSession, runs: list[Run]) -> DataFrame:
    """One row per run; at most as many rows as there are models."""
    return spark.createDataFrame([(r.name, r.mean_r2, r.std_r2) for r in runs],
                                 "name string, mean_r2 double, std_r2 double")


def record_runs(spark: SparkSession, runs: list[Run], path: str, table: str = "runs") -> None:
    """Append the runs to a table under `path` and save the models that can be saved beside it."""
    rows = []
    for run in runs:
        target = None
        if hasattr(run.model, "write"):
            target = f"{path}/models/{run.name}"
            run.model.write().overwrite().save(target)
        rows.append((run.name, run.mean_r2, run.std_r2, target))
    spark.createDataFrame(rows, schema.RUNS).write.mode("append").parquet(f"{path}/{table}")


def best_runs(spark: SparkSession, path: str, table: str = "runs") -> DataFrame:
    """Each model name's best score of all recorded runs; `place` 1 is the best of all."""
    runs = spark.read.schema(schema.RUNS).parquet(f"{path}/{table}")
    best = runs.groupBy("name").agg(F.max("mean_r2").alias("mean_r2"), F.count(F.lit(1)).alias("runs"))
    # as many rows as there are model names
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("mean_r2"), "name")))


def r2(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return RegressionEvaluator(metricName="r2", labelCol=label, predictionCol=prediction).evaluate(predicted)
