"""AdaBoost.R2 (Drucker 1997): weighted trees, each grown where the ones before it were wrong, and their weighted median.

Rows that a tree predicts well lose weight before the next one is grown. Trees are grown on all rows with their weights, not on
a sample drawn by them, so there is no random choice. A round is a weighted tree, two aggregates and one written table; nothing
but aggregates comes to the driver.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kamienica.operators.cleanse import quoted
from kamienica.session import settle

LOSSES = {"linear": lambda e: e, "square": lambda e: e * e, "exponential": lambda e: 1 - F.exp(-e)}


class _HasRounds(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    rounds = Param(Params._dummy(), "rounds", "most trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinks every tree's say", TypeConverters.toFloat)
    loss = Param(Params._dummy(), "loss", "linear, square or exponential", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the trees", TypeConverters.toInt)


class AdaBoostR2(Estimator, _HasRounds):
    """Ends early when a tree fits perfectly, or when its mean loss reaches one half (that tree is left out, unless it is the
    first)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rounds=50, maxDepth=3,
                 learningRate=1.0, loss="linear", seed=123):
        super().__init__()
        self._setDefault(rounds=50, maxDepth=3, learningRate=1.0, loss="linear", seed=123)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> AdaBoostR2Model:
        get, label = self.getOrDefault, self.getLabelCol()
        rate, shape = get("learningRate"), LOSSES[get("loss")]
        rows = settle(dataset.select(quoted(self.getFeaturesCol()).alias("x"), quoted(label).cast("double").alias("y"),
                                     F.lit(1.0).alias("weight")))
        trees, votes = [], []
        for n in range(get("rounds")):
            tree = DecisionTreeRegressor(featuresCol="x", labelCol="y", weightCol="weight", predictionCol="p",
                                         maxDepth=get("maxDepth"), seed=get("seed") + n).fit(rows)
            off = tree.transform(rows).select("x", "y", "weight", F.abs(F.col("y") - F.col("p")).alias("off"))
            most, total, count = off.agg(F.max(F.when(F.col("weight") > 0, F.col("off"))), F.sum("weight"),
                                         F.count("*")).first()
            if not most:
                trees, votes = [*trees, tree], [*votes, 1.0]
                break
            loss = shape(F.col("off") / most)
            mean = off.agg(F.sum(F.col("weight") * loss) / F.lit(total)).first()[0]
            if mean >= 0.5:
                if not trees:
                    trees, votes = [tree], [1.0]
                break
            beta = mean / (1 - mean)
            trees.append(tree)
            votes.append(rate * math.log(1 / beta))
            if n + 1 < get("rounds"):
                rows = settle(off.select("x", "y", (F.col("weight") * (count / total) * F.pow(F.lit(beta), (1 - loss) * rate))
                                         .alias("weight")))
        return self._copyValues(AdaBoostR2Model(trees, votes))


def weighted_median(values: list[Column], weights: list[float]) -> Column:
    """The least value up to which the weights make up half of all."""
    pairs = F.array_sort(F.array(*[F.struct(v.alias("v"), F.lit(w).alias("w")) for v, w in zip(values, weights)]))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("found"))
    half = sum(weights) / 2

    def add(state: Column, pair: Column) -> Column:
        upto = state["sum"] + pair["w"]
        return F.struct(upto.alias("sum"), F.coalesce(state["found"], F.when(upto >= half, pair["v"])).alias("found"))

    last = F.element_at(pairs, -1)["v"]  # should rounding keep the sum below one half
    return F.coalesce(F.aggregate(pairs, start, add, lambda s: s["found"]), last)


class _EnsembleWriter:
    def __init__(self, model: AdaBoostR2Model):
        self.model, self.replace = model, False

    def overwrite(self) -> _EnsembleWriter:
        self.replace = True
        return self

    def save(self, path: str) -> None:
        for i, tree in enumerate(self.model.trees):
            writer = tree.write()
            (writer.overwrite() if self.replace else writer).save(f"{path}/tree-{i}")
        about = json.dumps({"votes": self.model.votes, "features": self.model.getFeaturesCol(),
                            "prediction": self.model.getPredictionCol()})
        SparkSession.active().createDataFrame([(about,)], "about string").write.mode(
            "overwrite" if self.replace else "errorifexists").parquet(f"{path}/about")


class AdaBoostR2Model(Model, _HasRounds):
    def __init__(self, trees: list | None = None, votes: list[float] | None = None):
        super().__init__()
        self.trees, self.votes = trees or [], votes or []

    def copy(self, extra=None):
        other = super().copy(extra)
        other.trees, other.votes = self.trees, self.votes
        return other

    def write(self) -> _EnsembleWriter:
        return _EnsembleWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> AdaBoostR2Model:
        about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
        trees = [DecisionTreeRegressionModel.load(f"{path}/tree-{i}") for i in range(len(about["votes"]))]
        return AdaBoostR2Model(trees, about["votes"])._set(featuresCol=about["features"], predictionCol=about["prediction"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df, names = dataset, [f"_tree{i}" for i in range(len(self.trees))]
        for tree, name in zip(self.trees, names):
            df = tree.copy({tree.featuresCol: self.getFeaturesCol(), tree.predictionCol: name}).transform(df)
        median = weighted_median([F.col(name) for name in names], self.votes)
        return df.select(*[quoted(c) for c in dataset.columns], median.alias(self.getPredictionCol()))
