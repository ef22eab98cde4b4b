"""Regression by a network with one hidden layer, trained in local passes over blocks and averaged.

Rows are dealt to blocks and ordered by a hash of their key, as for the stochastic steps of `sgd`. In each round every block
starts from the common state (parameters and the two running moments of Adam), goes a few times through its rows in batches,
and the blocks' states are averaged by rows in a tree of fixed order. So parameters do not depend on partitions, and what
moves in a round is three numbers a parameter and block, whatever the rows. The number of parameters is checked.
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
from kamienica.operators.kernel import by_batch
from kamienica.operators.sgd import ROUND, added_up, as_blocks

MOST_PARAMETERS = 1 << 18  # a block sends three times as many numbers
KEEP_FIRST, KEEP_SECOND, TINY = 0.9, 0.999, 1e-8  # running means of Adam


def parts(flat: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Views of the parameters: weights (hidden, width) and offsets of the hidden layer, weights and offset of the output."""
    hidden = (len(flat) - 1) // (width + 2)
    edge = hidden * width
    return flat[:edge].reshape(hidden, width), flat[edge:edge + hidden], flat[edge + hidden:-1], flat[-1:]


def first_parameters(width: int, hidden: int, seed: int) -> np.ndarray:
    """Even draws between bounds that shrink with the units a layer connects."""
    rng = np.random.default_rng(seed)
    inner, outer = math.sqrt(6 / (width + hidden)), math.sqrt(6 / (hidden + 1))
    return np.concatenate([rng.uniform(-inner, inner, hidden * (width + 1)), rng.uniform(-outer, outer, hidden + 1)])


def predict(x: np.ndarray, flat: np.ndarray) -> np.ndarray:
    inner, inner_off, outer, outer_off = parts(flat, x.shape[1])
    return np.maximum(x @ inner.T + inner_off, 0) @ outer + outer_off


def slopes(x: np.ndarray, y: np.ndarray, flat: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Gradient and value of the mean of squared errors / 2 plus alpha / 2 squared weights a row of the batch."""
    inner, inner_off, outer, outer_off = parts(flat, x.shape[1])
    active = np.maximum(x @ inner.T + inner_off, 0)
    off = active @ outer + outer_off - y
    back = np.outer(off, outer) * (active > 0)
    rows = len(y)
    gradient = np.concatenate([((back.T @ x + alpha * inner) / rows).ravel(), back.mean(axis=0),
                               (active.T @ off + alpha * outer) / rows, [off.mean()]])
    weights = (inner ** 2).sum() + (outer ** 2).sum()
    return gradient, float((off @ off + alpha * weights) / (2 * rows))


def passes(x: np.ndarray, y: np.ndarray, state: np.ndarray, seen: int, times: int, batch: int, eta: float,
           alpha: float) -> tuple[np.ndarray, float]:
    """State (parameters, first and second moments) after `times` passes, and the loss summed over the rows of the last."""
    flat, first, second = (part.copy() for part in np.split(state, 3))
    total = 0.0
    for _ in range(times):
        total = 0.0
        for at in range(0, len(y), batch):
            seen += 1
            gradient, loss = slopes(x[at:at + batch], y[at:at + batch], flat, alpha)
            total += loss * len(y[at:at + batch])
            first += (1 - KEEP_FIRST) * (gradient - first)
            second += (1 - KEEP_SECOND) * (gradient * gradient - second)
            step = eta * math.sqrt(1 - KEEP_SECOND ** seen) / (1 - KEEP_FIRST ** seen)
            flat -= step * first / (np.sqrt(second) + TINY)
    return np.concatenate([flat, first, second]), total


class _HasLayers(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    keyCol = Param(Params._dummy(), "keyCol", "unique key column", TypeConverters.toString)
    hidden = Param(Params._dummy(), "hidden", "units of the hidden layer", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "weight of the squared weights", TypeConverters.toFloat)
    eta = Param(Params._dummy(), "eta", "size of steps", TypeConverters.toFloat)
    batchRows = Param(Params._dummy(), "batchRows", "rows of a step", TypeConverters.toInt)
    passes = Param(Params._dummy(), "passes", "passes of a block before states are averaged", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "most rounds", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least fall of the loss that counts, as a share of it", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "rounds without a fall before it ends", TypeConverters.toInt)
    blockRows = Param(Params._dummy(), "blockRows", "rows in a block", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the first parameters and of the order of rows", TypeConverters.toInt)


class NetworkRegressor(Estimator, _HasLayers):
    """One hidden layer of rectified units, squared loss, Adam. Features should be scaled; rows without features or label
    are left out."""

    @keyword_only
    def __init__(self, *, keyCol="id", featuresCol="features", labelCol="label", predictionCol="prediction", hidden=100,
                 alpha=1e-4, eta=1e-3, batchRows=200, passes=5, maxIter=40, tol=1e-3, patience=3, blockRows=4096, seed=123):
        super().__init__()
        self._setDefault(keyCol="id", hidden=100, alpha=1e-4, eta=1e-3, batchRows=200, passes=5, maxIter=40, tol=1e-3,
                         patience=3, blockRows=4096, seed=123)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NetworkModel:
        get = self.getOrDefault
        features, label = self.getFeaturesCol(), self.getLabelCol()
        known = dataset.where(quoted(features).isNotNull() & quoted(label).isNotNull())
        rows, blocks, width = as_blocks(known, get("keyCol"), features, label, get("blockRows"), get("seed"))
        if get("hidden") * (width + 2) >= MOST_PARAMETERS:
            raise ValueError(f"{get('hidden')} units on {width} features are too many")
        flat = first_parameters(width, get("hidden"), get("seed"))
        state = np.concatenate([flat, np.zeros(2 * len(flat))])
        times, batch, eta, alpha = get("passes"), get("batchRows"), get("eta"), get("alpha")
        best, idle, losses = math.inf, 0, []
        for done in range(get("maxIter")):
            def run(batches: Iterator[pa.RecordBatch], state=state, done=done) -> Iterator[pa.RecordBatch]:
                for arrow in batches:
                    for block, x, y in zip(*(arrow.column(i) for i in range(3))):
                        values = y.values.to_numpy()
                        table = x.values.flatten().to_numpy().reshape(len(values), width)
                        seen = done * times * -(-len(values) // batch)
                        after, loss = passes(table, values, state, seen, times, batch, eta, alpha)
                        yield pa.RecordBatch.from_pydict({"block": [block.as_py()], "n": [len(values)],
                                                          "weights": [(after * len(values)).tolist()], "loss": [loss]})
            row = added_up(rows.mapInArrow(run, ROUND), blocks)
            state = np.array(row["weights"]) / row["n"]
            losses.append(row["loss"] / row["n"])
            if not np.isfinite(state).all():
                raise ValueError("the steps do not settle; scale the features first")
            idle = 0 if losses[-1] < best * (1 - get("tol")) else idle + 1
            best = min(best, losses[-1])
            if idle >= get("patience"):
                break
        return self._copyValues(NetworkModel(state[:len(flat)], losses))


class _NetworkWriter:
    """Parameters and column names as one row."""

    def __init__(self, model: NetworkModel):
        self.model, self.mode = model, "errorifexists"

    def overwrite(self) -> _NetworkWriter:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        model = self.model
        SparkSession.active().createDataFrame(
            [(model.parameters.tolist(), model.getFeaturesCol(), model.getPredictionCol())],
            "parameters array<double>, features string, prediction string").write.mode(self.mode).parquet(path)


class NetworkModel(Model, _HasLayers):
    """Predictions of whole Arrow batches; a row without features has none."""

    def __init__(self, parameters: np.ndarray | None = None, losses: list[float] | None = None):
        super().__init__()
        self.parameters = np.zeros(0) if parameters is None else parameters
        self.losses = losses or []  # mean loss of the last pass of every round

    def copy(self, extra=None):
        other = super().copy(extra)
        other.parameters, other.losses = self.parameters, self.losses
        return other

    def write(self) -> _NetworkWriter:
        return _NetworkWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> NetworkModel:
        row = spark.read.parquet(path).first()
        return NetworkModel(np.array(row["parameters"]))._set(featuresCol=row["features"], predictionCol=row["prediction"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parameters, features = self.parameters, quoted(self.getFeaturesCol())
        predicted = by_batch(lambda x: predict(x, parameters), "double")
        return dataset.withColumn(self.getPredictionCol(), predicted(F.when(features.isNotNull(), vector_to_array(features))))
