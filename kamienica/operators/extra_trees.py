"""Extremely randomised trees (Geurts 2006): every node draws one threshold for each feature and takes the best.

All trees grow level by level. A level is two aggregates over the written rows, each combined in the tasks before it is
shuffled: ranges and sums of every (tree, node, feature), from which the thresholds are drawn, then the sums of the left side of
every drawn threshold. A draw is a hash of seed, tree, node and feature, so a forest does not depend on partitions. What comes to
the driver is bounded by trees * 2^depth * features, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

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
from kamienica.session import settle

NOTHING = 1e-12  # a spread below this part of the square sum is rounding


def draw(seed: int, tree: int, node: int, feature: int) -> float:
    """Between 0 (included) and 1, from the key alone."""
    return int(hashlib.md5(f"{seed}:{tree}:{node}:{feature}".encode()).hexdigest()[:8], 16) / 2 ** 32


@dataclass
class Forest:
    """Arrays of shape (trees, nodes); the children of node k are 2k and 2k + 1, the root is 1; a leaf has feature -1."""
    feature: np.ndarray
    split: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Forest:
        shape = (trees, 2 ** (depth + 1))
        return cls(np.full(shape, -1, np.int32), np.zeros(shape), np.zeros(shape))

    def nodes(self, tree: int, x: np.ndarray, levels: int) -> np.ndarray:
        """The node each row has come to after some levels."""
        node, every = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(levels):
            feature = self.feature[tree, node]
            right = x[every, np.maximum(feature, 0)] > self.split[tree, node]
            node = np.where(feature < 0, node, 2 * node + right)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        depth = self.feature.shape[1].bit_length() - 2
        return np.mean([self.value[t, self.nodes(t, x, depth)] for t in range(len(self.feature))], axis=0)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y = batch.column(1).to_numpy()
    return batch.column(0).flatten().to_numpy().reshape(len(y), -1), y


FIRST = "tree int, node long, feature int, n double, s double, ss double, low double, high double"
SECOND = "tree int, node long, feature int, n double, s double"


def _gathered(schema: str, found: Callable) -> Callable:
    """A task's rows of (tree, node, feature, values): sums, and for `low` and `high` the extremes, over its batches."""
    names = [c.split()[0] for c in schema.split(", ")]
    how = {n: {"low": "min", "high": "max"}.get(n, "sum") for n in names[3:]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            x, y = _rows(batch)
            parts = [p for p in found(x, y) if len(p)] + ([held] if held is not None else [])
            if parts:
                held = pd.concat(parts).groupby(names[:3], as_index=False).agg(how)
        if held is not None:
            yield pa.RecordBatch.from_pandas(held.astype({"tree": "int32", "feature": "int32"})[names], preserve_index=False)
    return run


def _spread(nodes: np.ndarray, tree: int, width: int, **columns: np.ndarray) -> pd.DataFrame:
    """(tree, node, feature, values) from values by (node, feature)."""
    return pd.DataFrame({"tree": tree, "node": np.repeat(nodes, width), "feature": np.tile(np.arange(width), len(nodes)),
                         **{name: v.ravel() for name, v in columns.items()}})


def _by_node(node: np.ndarray, active: np.ndarray):
    """Order of the rows that are in active nodes, where each node's begin, and the nodes."""
    order = np.flatnonzero(active[node])
    order = order[np.argsort(node[order], kind="stable")]
    ranked = node[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else order
    return order, first, ranked[first] if len(order) else ranked


def _ranges(forest, active: np.ndarray, level: int) -> Callable:
    def found(x, y):
        width = x.shape[1]
        for tree in range(len(active)):
            order, first, nodes = _by_node(forest.value.nodes(tree, x, level), active[tree])
            if len(order):
                rows, values = x[order], y[order]
                sums = [np.repeat(np.add.reduceat(v, first), width) for v in (np.ones(len(order)), values, values * values)]
                yield _spread(nodes, tree, width, n=sums[0], s=sums[1], ss=sums[2],
                              low=np.minimum.reduceat(rows, first), high=np.maximum.reduceat(rows, first))
    return _gathered(FIRST, found)


def _left_sides(forest, drawn, active: np.ndarray, level: int) -> Callable:
    def found(x, y):
        for tree in range(len(active)):
            node = forest.value.nodes(tree, x, level)
            order, first, nodes = _by_node(node, active[tree])
            if len(order):
                at, splits = drawn.value[tree]
                left = x[order] <= splits[np.searchsorted(at, node[order])]
                yield _spread(nodes, tree, x.shape[1], n=np.add.reduceat(left.astype(float), first),
                              s=np.add.reduceat(left * y[order][:, None], first))
    return _gathered(SECOND, found)


def grow(rows: DataFrame, trees: int, depth: int, least: int, seed: int) -> Forest:
    """A forest over (x array<double>, y double)."""
    context = rows.sparkSession.sparkContext
    forest = Forest.empty(trees, depth)
    active = np.zeros((trees, 2 ** (depth + 1)), bool)
    active[:, 1] = True
    for level in range(depth + 1):
        shared = context.broadcast(forest)  # trees * 2^(depth + 1) nodes
        ranges = rows.mapInArrow(_ranges(shared, active, level), FIRST).groupBy("tree", "node", "feature").agg(
            *[F.sum(c).alias(c) for c in ("n", "s", "ss")], F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
        ranges = ranges.sort_values(["tree", "node", "feature"])
        splitting: dict[int, tuple[list, list]] = {}
        totals = {}
        for (tree, node), own in ranges.groupby(["tree", "node"]):
            n, s, ss = own[["n", "s", "ss"]].iloc[0]
            forest.value[tree, node] = s / n
            low, high = own.low.to_numpy(), own.high.to_numpy()
            if level < depth and n >= least and ss - s * s / n > NOTHING * ss and (low < high).any():
                draws = np.array([draw(seed, tree, node, f) for f in range(len(low))])
                nodes, splits = splitting.setdefault(int(tree), ([], []))
                nodes.append(node)
                splits.append(np.where(low < high, low + (high - low) * draws, np.nan))  # nothing is left of no number
                totals[tree, node] = n, s
        active = np.zeros_like(active)
        if not splitting:
            break
        drawn = {t: (np.array(nodes), np.array(splits)) for t, (nodes, splits) in splitting.items()}
        for tree, (nodes, _) in drawn.items():
            active[tree, nodes] = True
        sides = rows.mapInArrow(_left_sides(shared, context.broadcast(drawn), active, level), SECOND).groupBy(
            "tree", "node", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()
        active = np.zeros_like(active)
        for (tree, node), own in sides.sort_values(["tree", "node", "feature"]).groupby(["tree", "node"]):
            n, s = totals[tree, node]
            left, sums = own.n.to_numpy(), own.s.to_numpy()
            fits = (left > 0) & (left < n)
            gain = np.full(len(left), -np.inf)
            gain[fits] = sums[fits] ** 2 / left[fits] + (s - sums[fits]) ** 2 / (n - left[fits])
            best = int(gain.argmax())
            if np.isfinite(gain[best]):
                at = np.searchsorted(drawn[tree][0], node)
                forest.feature[tree, node], forest.split[tree, node] = best, drawn[tree][1][at][best]
                active[tree, [2 * node, 2 * node + 1]] = True
    return forest


class _HasTrees(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    leastRows = Param(Params._dummy(), "leastRows", "rows a node needs to be split", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)


class ExtraTreesRegressor(Estimator, _HasTrees):
    """All rows grow every tree; all features are drawn at every node. Depth is bounded, for a forest is held in memory."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", numTrees=100, maxDepth=10,
                 leastRows=2, seed=123):
        super().__init__()
        self._setDefault(numTrees=100, maxDepth=10, leastRows=2, seed=123)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ExtraTreesModel:
        rows = settle(dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"),
                                     quoted(self.getLabelCol()).cast("double").alias("y")))
        if rows.isEmpty():
            raise ValueError("no rows to fit on")
        get = self.getOrDefault
        forest = grow(rows, get("numTrees"), get("maxDepth"), get("leastRows"), get("seed"))
        return self._copyValues(ExtraTreesModel(forest))


class _ForestWriter:
    """One row per tree, and one with the names of columns."""

    def __init__(self, model: ExtraTreesModel):
        self.model, self.mode = model, "errorifexists"

    def overwrite(self) -> _ForestWriter:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        spark, model = SparkSession.active(), self.model
        rows = [(t, f.tolist(), s.tolist(), v.tolist()) for t, (f, s, v) in enumerate(
            zip(model.forest.feature, model.forest.split, model.forest.value))]
        spark.createDataFrame(rows, "tree int, feature array<int>, split array<double>, value array<double>").write.mode(
            self.mode).parquet(f"{path}/trees")
        spark.createDataFrame([(model.getFeaturesCol(), model.getPredictionCol())], "features string, prediction string").write.mode(
            self.mode).parquet(f"{path}/columns")


class ExtraTreesModel(Model, _HasTrees):
    def __init__(self, forest: Forest | None = None):
        super().__init__()
        self.forest = forest

    def copy(self, extra=None):
        other = super().copy(extra)
        other.forest = self.forest
        return other

    def write(self) -> _ForestWriter:
        return _ForestWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ExtraTreesModel:
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        names = spark.read.parquet(f"{path}/columns").first()
        forest = Forest(*(np.array([r[c] for r in rows]) for c in ("feature", "split", "value")))
        return ExtraTreesModel(forest)._set(featuresCol=names["features"], predictionCol=names["prediction"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.forest)  # trees * 2^(depth + 1) nodes

        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(shared.value.predict(np.array(batch.tolist())) if len(batch) else [], dtype=float)

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))
