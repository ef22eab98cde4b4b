"""Kernel regression with an epsilon-insensitive loss, on random Fourier features of a Gaussian kernel.

A row's features are turned into `components` cosines whose inner products approximate exp(-gamma |x - y|^2), with an error
that falls with the square root of their number. All draws come from hashes of (seed, component, feature), so that a map is
known by its seed. In this space the regression is linear: |w|^2 / 2 + C * sum of max(0, |y - f| - epsilon), rounded off on
the first `smooth` beyond the tube, which changes the optimum by at most C * rows * smooth / 2.

Each round solves weighted least squares: a row outside the tube counts by the inverse of how far it lies outside. What a
block of rows sends is the weighted products of its features, (components + 1)^2 / 2 numbers, whatever its rows, added up in
a tree of fixed order; a second pass finds the best of a few step lengths. So weights do not depend on partitions. Blocks hold
as many rows as fit a bounded row, so that products stay smaller than the rows; the number of components is checked.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kamienica.operators.cleanse import quoted
from kamienica.operators.sgd import ROUND, added_up, as_blocks

MOST_COMPONENTS = 1024  # a block sends half the square of it
MOST_DRAWS = 1 << 22  # components times features: what every task gets
STEPS = np.array([2.0 ** -i for i in range(12)])
CHUNK = 4096  # rows whose cosines are held at a time


class FourierMap:
    """cos(draws x + phases), scaled so that inner products are about the kernel's values."""

    def __init__(self, width: int, components: int, gamma: float, seed: int):
        if components > MOST_COMPONENTS or width * components > MOST_DRAWS:
            raise ValueError(f"{components} components of {width} features are too many")

        def shares(name: str) -> tuple[float, float]:
            """Two numbers, the first above 0 and at most 1, the second from 0 and below 1."""
            digest = hashlib.md5(name.encode()).hexdigest()
            return (int(digest[:8], 16) + 1) / 2 ** 32, int(digest[8:16], 16) / 2 ** 32

        def normal(name: str) -> float:
            first, second = shares(name)
            return math.sqrt(-2 * math.log(first)) * math.cos(2 * math.pi * second)

        self.draws = math.sqrt(2 * gamma) * np.array(
            [[normal(f"{seed}:{c}:{j}") for j in range(width)] for c in range(components)]).reshape(components, width)
        self.phases = np.array([2 * math.pi * shares(f"{seed}:{c}")[1] for c in range(components)])

    def apply(self, x: np.ndarray) -> np.ndarray:
        """One row of components for each row of `x`."""
        return np.cos(x @ self.draws.T + self.phases) * math.sqrt(2 / len(self.phases))


def beyond(off: np.ndarray, epsilon: float, smooth: float) -> np.ndarray:
    """The loss of residuals: 0 in the tube, then a square up to `smooth`, then straight."""
    out = np.maximum(np.abs(off) - epsilon, 0)
    return np.where(out < smooth, out * out / (2 * smooth), out - smooth / 2)


def products(z: np.ndarray, y: np.ndarray, weights: np.ndarray, epsilon: float, smooth: float) -> tuple[np.ndarray, float]:
    """The upper half of the weighted products of (z, 1, target), and the loss at `weights`."""
    off = y - z @ weights[:-1] - weights[-1]
    far = np.abs(off) - epsilon
    counts = np.where(far > 0, 1 / np.maximum(far, smooth), 0)
    every = np.column_stack([z, np.ones(len(y)), y - np.sign(off) * epsilon])
    whole = every.T @ (every * counts[:, None])
    return whole[np.triu_indices(len(whole))], float(beyond(off, epsilon, smooth).sum())


def losses_along(z: np.ndarray, y: np.ndarray, weights: np.ndarray, way: np.ndarray, epsilon: float,
                 smooth: float) -> tuple[np.ndarray, float]:
    """The loss at weights + step * way for each of the steps."""
    off, moved = y - z @ weights[:-1] - weights[-1], z @ way[:-1] + way[-1]
    return np.array([beyond(off - s * moved, epsilon, smooth).sum() for s in STEPS]), 0.0


def over_blocks(rows: DataFrame, blocks: int, lift: Callable[[np.ndarray], np.ndarray],
                measure: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """The sums of `measure(lift(features), labels)` over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, x, y in zip(*(batch.column(i) for i in range(3))):
                values = y.values.to_numpy()
                table = x.values.flatten().to_numpy().reshape(len(values), -1)
                total, loss = 0, 0.0
                for at in range(0, len(values), CHUNK):
                    more, lost = measure(lift(table[at:at + CHUNK]), values[at:at + CHUNK])
                    total, loss = total + more, loss + lost
                yield pa.RecordBatch.from_pydict({"block": [block.as_py()], "n": [len(values)], "weights": [total.tolist()],
                                                  "loss": [loss]})
    row = added_up(rows.mapInArrow(run, ROUND), blocks)
    return np.array(row["weights"]), row["loss"]


def by_batch(of: Callable[[np.ndarray], np.ndarray], kind: str):
    """A function of arrays that hands `of` a bounded number of rows at a time; null stays null."""
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            result = pd.Series([None] * len(batch), index=batch.index, dtype="object")
            known = np.flatnonzero(batch.notna())
            for at in range(0, len(known), CHUNK):
                part = known[at:at + CHUNK]
                result.iloc[part] = list(of(np.stack(batch.iloc[part].to_list())))
            yield result
    return run


def with_components(df: DataFrame, features: str, fourier: FourierMap, name: str) -> DataFrame:
    """The table with the components of the array column `features`, as an array."""
    return df.withColumn(name, by_batch(fourier.apply, "array<double>")(quoted(features)))


class _HasKernel(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    keyCol = Param(Params._dummy(), "keyCol", "unique key column", TypeConverters.toString)
    components = Param(Params._dummy(), "components", "number of cosines", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "of the kernel; 0: one by features and their variance", TypeConverters.toFloat)
    cost = Param(Params._dummy(), "cost", "weight of the loss against the squared weights", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half the width of the tube", TypeConverters.toFloat)
    smooth = Param(Params._dummy(), "smooth", "where the loss turns straight beyond the tube", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most rounds", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least fall of the objective that counts, as a share of it", TypeConverters.toFloat)
    blockRows = Param(Params._dummy(), "blockRows", "most rows in a block", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)


def scaled_gamma(rows: DataFrame, blocks: int) -> float:
    """1 / (features * variance of all their values), 1 where nothing varies."""
    (total, values, count), _ = over_blocks(rows, blocks, np.asarray, lambda x, y: (np.array([x.sum(), x.size, len(x)]), 0.0))
    mean = total / max(values, 1)
    (spread,), _ = over_blocks(rows, blocks, np.asarray, lambda x, y: (np.array([((x - mean) ** 2).sum()]), 0.0))
    return float(count / spread) if spread > 0 else 1.0


class KernelRegressor(Estimator, _HasKernel):
    """Epsilon-insensitive regression on random Fourier features. Rows without features or label are left out."""

    @keyword_only
    def __init__(self, *, keyCol="id", featuresCol="features", labelCol="label", predictionCol="prediction", components=256,
                 gamma=0.0, cost=1.0, epsilon=0.1, smooth=1e-3, maxIter=100, tol=1e-5, blockRows=1 << 17, seed=123):
        super().__init__()
        self._setDefault(keyCol="id", components=256, gamma=0.0, cost=1.0, epsilon=0.1, smooth=1e-3, maxIter=100, tol=1e-5,
                         blockRows=1 << 17, seed=123)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> KernelModel:
        get = self.getOrDefault
        features, label, epsilon, smooth, cost = (self.getFeaturesCol(), self.getLabelCol(), get("epsilon"), get("smooth"),
                                                  get("cost"))
        known = dataset.where(quoted(features).isNotNull() & quoted(label).isNotNull())
        rows, blocks, width = as_blocks(known, get("keyCol"), features, label, get("blockRows"), get("seed"))
        gamma = get("gamma") or scaled_gamma(rows, blocks)
        fourier = FourierMap(width, get("components"), gamma, get("seed"))
        size = get("components") + 1
        half = np.triu_indices(size + 1)
        weights, objectives = np.zeros(size), []
        for _ in range(get("maxIter")):
            flat, loss = over_blocks(rows, blocks, fourier.apply, lambda z, y: products(z, y, weights, epsilon, smooth))
            objectives.append(float(weights[:-1] @ weights[:-1]) / 2 + cost * loss)
            whole = np.zeros((size + 1, size + 1))
            whole[half] = flat
            whole += np.triu(whole, 1).T
            bent = np.append(np.full(size - 1, 1 / cost), 1e-12)
            way = np.linalg.solve(whole[:size, :size] + np.diag(bent), whole[:size, size]) - weights
            lost, _ = over_blocks(rows, blocks, fourier.apply, lambda z, y: losses_along(z, y, weights, way, epsilon, smooth))
            ends = weights + STEPS[:, None] * way
            reached = (ends[:, :-1] ** 2).sum(axis=1) / 2 + cost * lost
            best = int(reached.argmin())
            if not reached[best] < objectives[-1] * (1 - get("tol")):
                break
            weights = ends[best]
        return self._copyValues(KernelModel(fourier, weights, objectives, (width, gamma, get("seed"))))


class _KernelWriter:
    """Weights and what the map is drawn from, as one row."""

    def __init__(self, model: KernelModel):
        self.model, self.mode = model, "errorifexists"

    def overwrite(self) -> _KernelWriter:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        model = self.model
        SparkSession.active().createDataFrame(
            [(model.weights.tolist(), *model.drawn, model.getFeaturesCol(), model.getPredictionCol())],
            "weights array<double>, width int, gamma double, seed int, features string, prediction string").write.mode(
            self.mode).parquet(path)


class KernelModel(Model, _HasKernel):
    """Predictions of whole Arrow batches; a row without features has none."""

    def __init__(self, fourier: FourierMap | None = None, weights: np.ndarray | None = None,
                 objectives: list[float] | None = None, drawn: tuple[int, float, int] = (0, 0.0, 0)):
        super().__init__()
        self.fourier, self.weights, self.drawn = fourier, weights, drawn
        self.objectives = objectives or []  # at the start of every round

    def copy(self, extra=None):
        other = super().copy(extra)
        other.fourier, other.weights, other.objectives, other.drawn = self.fourier, self.weights, self.objectives, self.drawn
        return other

    def write(self) -> _KernelWriter:
        return _KernelWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> KernelModel:
        row = spark.read.parquet(path).first()
        drawn = (row["width"], row["gamma"], row["seed"])
        weights = np.array(row["weights"])
        return KernelModel(FourierMap(drawn[0], len(weights) - 1, *drawn[1:]), weights, [], drawn)._set(
            featuresCol=row["features"], predictionCol=row["prediction"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fourier, weights, features = self.fourier, self.weights, quoted(self.getFeaturesCol())
        predicted = by_batch(lambda x: fourier.apply(x) @ weights[:-1] + weights[-1], "double")
        return dataset.withColumn(self.getPredictionCol(), predicted(F.when(features.isNotNull(), vector_to_array(features))))
