"""Linear regression by stochastic gradient steps, with the same weights however the table is partitioned.

Rows are dealt to blocks by a hash of their key and stand in their block in the order of that hash. In each round every block
starts from the common weights and goes through its rows, one step a row, steps shrinking with the number of rows the block
has seen; the blocks' weights are then averaged by rows, in a tree whose order of addition is fixed by the block numbers. A
round is one pass over the written blocks; what moves is a vector a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kamienica.operators.cleanse import quoted
from kamienica.operators.scale import key_hash
from kamienica.session import settle

CELLS = 1 << 20  # numbers in a block, so that it fits a row whatever the number of features
FAN = 64  # blocks added up by one node of the tree
STEEPEST = 1e12  # no gradient counts for more


def as_blocks(rows: DataFrame, key: str, features: str, label: str, block_rows: int, seed: int) -> tuple[DataFrame, int, int]:
    """(block, rows) with the rows of a block in order, written; the number of blocks and of features."""
    slim = settle(rows.select(key_hash(quoted(key), seed).alias("hash"), quoted(key).cast("string").alias("key"),
                              vector_to_array(features).alias("x"), quoted(label).cast("double").alias("y")))
    total, width = slim.agg(F.count("*"), F.max(F.size("x"))).first()
    if not total:
        raise ValueError("no rows to fit on")
    blocks = max(1, -(-total // max(1, min(block_rows, CELLS // (width + 1)))))
    dealt = slim.groupBy(F.pmod("hash", F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("hash", "key", "x", "y"))).alias("rows"))
    return settle(dealt.select("block", F.transform("rows", lambda r: r["x"]).alias("x"),
                               F.transform("rows", lambda r: r["y"]).alias("y"))), blocks, width


def steps(x: np.ndarray, y: np.ndarray, weights: np.ndarray, seen: int, alpha: float, eta: float,
          power: float) -> tuple[np.ndarray, float]:
    """Weights (the intercept last) after one step a row, and the sum of the losses met on the way."""
    weights, loss = weights.copy(), 0.0
    inner = weights[:-1]
    for t, (row, value) in enumerate(zip(x, y), seen + 1):
        off = float(inner @ row) + weights[-1] - value
        loss += off * off / 2
        step = eta / t ** power
        off = min(max(off, -STEEPEST), STEEPEST)
        inner *= 1 - step * alpha
        inner -= step * off * row
        weights[-1] -= step * off
    return weights, loss


ROUND = "block long, n long, weights array<double>, loss double"


def one_round(blocks: DataFrame, weights: np.ndarray, done: int, alpha: float, eta: float, power: float) -> DataFrame:
    """A pass of every block from the same weights; weights are multiplied by the rows of the block."""
    width = len(weights) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, x, y in zip(*(batch.column(i) for i in range(3))):
                values = y.values.to_numpy()
                table = x.values.flatten().to_numpy().reshape(len(values), width)
                after, loss = steps(table, values, weights, done * len(values), alpha, eta, power)
                rows.append((block.as_py(), len(values), (after * len(values)).tolist(), loss))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)],
                                             names=["block", "n", "weights", "loss"])
    return blocks.mapInArrow(run, ROUND)


def added_up(parts: DataFrame, blocks: int):
    """One row with the sums, added in the order of the blocks, FAN at a time."""
    while True:
        gathered = parts.groupBy(F.expr(f"block div {FAN}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("block", "n", "weights", "loss"))).alias("r"))
        parts = gathered.select(
            "block", F.expr("aggregate(r, 0L, (s, p) -> s + p.n)").alias("n"),
            F.expr("aggregate(slice(r, 2, size(r)), r[0].weights, (s, p) -> zip_with(s, p.weights, (a, b) -> a + b))")
            .alias("weights"), F.expr("aggregate(r, 0D, (s, p) -> s + p.loss)").alias("loss"))
        blocks = -(-blocks // FAN)
        if blocks == 1:
            return parts.first()


class _HasSteps(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    keyCol = Param(Params._dummy(), "keyCol", "unique key column", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "weight of the squared coefficients", TypeConverters.toFloat)
    eta = Param(Params._dummy(), "eta", "first step", TypeConverters.toFloat)
    power = Param(Params._dummy(), "power", "steps shrink with rows seen to this power", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most rounds", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least fall of the loss that counts, as a share of it", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "rounds without a fall before it ends", TypeConverters.toInt)
    blockRows = Param(Params._dummy(), "blockRows", "rows in a block", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the order of rows", TypeConverters.toInt)


class SGDRegressor(Estimator, _HasSteps):
    """Squared loss with a small squared penalty, steps eta / t^power. Features should be scaled."""

    @keyword_only
    def __init__(self, *, keyCol="id", featuresCol="features", labelCol="label", predictionCol="prediction", alpha=1e-4,
                 eta=0.01, power=0.25, maxIter=1000, tol=1e-3, patience=5, blockRows=4096, seed=123):
        super().__init__()
        self._setDefault(keyCol="id", alpha=1e-4, eta=0.01, power=0.25, maxIter=1000, tol=1e-3, patience=5, blockRows=4096,
                         seed=123)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SGDModel:
        get = self.getOrDefault
        rows, blocks, width = as_blocks(dataset, get("keyCol"), self.getFeaturesCol(), self.getLabelCol(), get("blockRows"),
                                        get("seed"))
        weights, best, idle, losses = np.zeros(width + 1), math.inf, 0, []
        for done in range(get("maxIter")):
            row = added_up(one_round(rows, weights, done, get("alpha"), get("eta"), get("power")), blocks)
            weights = np.array(row["weights"]) / row["n"]
            losses.append(row["loss"] / row["n"])
            if not (np.isfinite(weights).all() and math.isfinite(losses[-1])):
                raise ValueError("the steps do not settle; scale the features first")
            idle = 0 if losses[-1] < best * (1 - get("tol")) else idle + 1
            best = min(best, losses[-1])
            if idle >= get("patience") or best == 0:
                break
        return self._copyValues(SGDModel(weights, losses))


class _LinearWriter:
    """Coefficients and settings as one row."""

    def __init__(self, model: SGDModel):
        self.model, self.mode = model, "errorifexists"

    def overwrite(self) -> _LinearWriter:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        model = self.model
        spark.createDataFrame([(model.coefficients.tolist(), model.intercept, model.getFeaturesCol(), model.getPredictionCol())],
                              "coefficients array<double>, intercept double, features string, prediction string").write.mode(
            self.mode).parquet(path)


class SGDModel(Model, _HasSteps):
    """Linear prediction as built-in expressions."""

    def __init__(self, weights: np.ndarray | None = None, losses: list[float] | None = None):
        super().__init__()
        self.coefficients = np.zeros(0) if weights is None else weights[:-1]
        self.intercept = 0.0 if weights is None else float(weights[-1])
        self.losses = losses or []  # mean loss of every round

    def copy(self, extra=None):
        other = super().copy(extra)
        other.coefficients, other.intercept, other.losses = self.coefficients, self.intercept, self.losses
        return other

    def write(self) -> _LinearWriter:
        return _LinearWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SGDModel:
        row = spark.read.parquet(path).first()
        return SGDModel(np.array([*row["coefficients"], row["intercept"]]))._set(
            featuresCol=row["features"], predictionCol=row["prediction"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        products = F.zip_with(vector_to_array(self.getFeaturesCol()), F.lit(self.coefficients), lambda x, w: x * w)
        return dataset.withColumn(self.getPredictionCol(),
                                  F.aggregate(products, F.lit(self.intercept), lambda total, p: total + p))
