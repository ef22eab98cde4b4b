import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from kamienica.operators import boosting, extra_trees, scale, sgd
from kamienica.operators.boosting import AdaBoostR2, AdaBoostR2Model
from kamienica.operators.extra_trees import ExtraTreesModel, ExtraTreesRegressor
from kamienica.operators.sgd import SGDModel, SGDRegressor


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": range(900), "a": rng.normal(size=900), "b": rng.normal(size=900)})
    pdf["y"] = 4 * pdf.a - 2 * pdf.b + 1 + rng.normal(0, .2, 900)
    return pdf, scale.assemble(spark.createDataFrame(pdf), ["a", "b"], "y", ["id"])


def test_weights_do_not_depend_on_partitions(table):
    _, df = table
    fits = [SGDRegressor(blockRows=20, maxIter=4).fit(d) for d in (df.repartition(1), df.repartition(7), df.orderBy(F.desc("id")))]
    weights = [(*f.coefficients, f.intercept) for f in fits]
    assert weights[0] == weights[1] == weights[2]
    assert [f.losses for f in fits][0] == fits[1].losses


def test_near_the_closed_form_and_saved(spark, table, tmp_path):
    pdf, df = table
    fitted = SGDRegressor(blockRows=300).fit(df)
    matrix = np.column_stack([pdf.a, pdf.b, np.ones(len(pdf))])
    want = np.linalg.lstsq(matrix, pdf.y, rcond=None)[0]
    assert np.allclose([*fitted.coefficients, fitted.intercept], want, atol=0.05)
    assert len(fitted.losses) < 200 and fitted.losses[-1] < fitted.losses[0]
    fitted.write().overwrite().save(str(tmp_path / "sgd"))
    again = SGDModel.load(spark, str(tmp_path / "sgd"))
    rows = fitted.transform(df).orderBy("id").select("prediction").toPandas().prediction
    assert np.allclose(rows, matrix @ np.array([*fitted.coefficients, fitted.intercept]))
    assert again.transform(df).orderBy("id").select("prediction").toPandas().prediction.tolist() == rows.tolist()


def test_steps_equal_a_plain_loop():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(30, 3)), rng.normal(size=30)
    w, b, loss = [0.5, 0.0, -1.0], 0.25, 0.0
    for t, (row, value) in enumerate(zip(x.tolist(), y.tolist()), 8):
        off = sum(p * q for p, q in zip(w, row)) + b - value
        loss += off * off / 2
        eta = 0.01 / t ** 0.25
        w = [p * (1 - eta * 1e-4) - eta * off * q for p, q in zip(w, row)]
        b -= eta * off
    got, total = sgd.steps(x, y, np.array([0.5, 0.0, -1.0, 0.25]), 7, 1e-4, 0.01, 0.25)
    assert np.allclose(got, [*w, b]) and total == pytest.approx(loss)


def test_one_block_equals_the_loop_over_rounds(table):
    _, df = table
    small = df.where("id < 60")
    ordered = small.select(scale.key_hash(F.col("id"), 5).alias("h"), "features", "label").orderBy("h").collect()
    x, y = np.array([r["features"].toArray() for r in ordered]), np.array([r["label"] for r in ordered])
    weights = np.zeros(3)
    for done in range(3):
        weights, _ = sgd.steps(x, y, weights, done * 60, 1e-4, 0.01, 0.25)
    fitted = SGDRegressor(maxIter=3, seed=5).fit(small)
    assert np.allclose([*fitted.coefficients, fitted.intercept], weights, rtol=1e-12)


def test_unscaled_features_are_refused(spark):
    pdf = pd.DataFrame({"id": range(50), "a": np.arange(50) * 1e150, "y": np.arange(50.0)})
    with pytest.raises(ValueError, match="scale"):
        SGDRegressor().fit(scale.assemble(spark.createDataFrame(pdf), ["a"], "y", ["id"]))
    with pytest.raises(ValueError, match="no rows"):
        SGDRegressor().fit(scale.assemble(spark.createDataFrame(pdf).where("id < 0"), ["a"], "y", ["id"]))


def plain_adaboost(df, rounds, depth, loss):
    """The published procedure on plain arrays; only the trees come from Spark."""
    spark = df.sparkSession
    pdf = df.toPandas()
    weight, trees, votes = np.ones(len(pdf)) / len(pdf), [], []
    for n in range(rounds):
        rows = spark.createDataFrame(pdf.assign(weight=weight * len(pdf))[["features", "label", "weight"]])
        tree = DecisionTreeRegressor(maxDepth=depth, weightCol="weight", seed=123 + n).fit(rows)
        off = np.array([abs(tree.predict(x) - y) for x, y in zip(pdf.features, pdf.label)])
        share = {"linear": off / off.max(), "square": (off / off.max()) ** 2, "exponential": 1 - np.exp(-off / off.max())}[loss]
        mean = (weight * share).sum()
        if mean >= 0.5:
            break
        beta = mean / (1 - mean)
        trees.append(tree)
        votes.append(math.log(1 / beta))
        weight = weight * beta ** (1 - share)
        weight /= weight.sum()
    predictions = []
    for x in pdf.features:
        pairs = sorted((tree.predict(x), v) for tree, v in zip(trees, votes))
        upto = np.cumsum([v for _, v in pairs])
        predictions.append(pairs[int(np.searchsorted(upto, upto[-1] / 2))][0])
    return votes, predictions


@pytest.mark.parametrize("loss, depth", [("linear", 1), ("square", 3)])
def test_adaboost_equals_the_plain_procedure(spark, loss, depth, tmp_path):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": range(200), "a": rng.integers(0, 20, 200), "b": rng.integers(0, 9, 200)})
    pdf["y"] = pdf.a ** 2 - 7 * pdf.b + rng.normal(size=200)
    df = scale.assemble(spark.createDataFrame(pdf), ["a", "b"], "y", ["id"]).orderBy("id").coalesce(1)
    votes, want = plain_adaboost(df, 4, depth, loss)
    fitted = AdaBoostR2(rounds=4, maxDepth=depth, loss=loss).fit(df)
    assert fitted.votes == pytest.approx(votes)
    got = fitted.transform(df).orderBy("id").toPandas()
    assert got.columns.tolist() == ["id", "features", "label", "prediction"] and got.prediction.tolist() == pytest.approx(want)
    fitted.write().overwrite().save(str(tmp_path / "boost"))
    again = AdaBoostR2Model.load(spark, str(tmp_path / "boost")).transform(df).orderBy("id").toPandas()
    assert again.prediction.tolist() == got.prediction.tolist()


def test_adaboost_ends_early(spark):
    flat = scale.assemble(spark.createDataFrame([(i, float(i % 2), 3.0 * (i % 2)) for i in range(20)], "id int, a double, y double"),
                          ["a"], "y", ["id"])
    fitted = AdaBoostR2(rounds=5).fit(flat)
    assert len(fitted.trees) == 1 and fitted.votes == [1.0]


def test_weighted_median(spark):
    row = spark.range(1).select(boosting.weighted_median([F.lit(3.0), F.lit(1.0), F.lit(2.0)], [0.2, 0.5, 0.3]).alias("m"),
                                boosting.weighted_median([F.lit(3.0), F.lit(1.0), F.lit(2.0)], [5.0, 0.5, 0.3]).alias("n")).first()
    assert tuple(row) == (1.0, 3.0)


def plain_tree(x, y, seed, tree, depth):
    """The tree by recursion, with the same draws; returns a function of a row."""
    def node(at, rows, level):
        mean = y[rows].mean()
        if level == depth or len(rows) < 2 or y[rows].min() == y[rows].max():
            return lambda row: mean
        best = None
        for f in range(x.shape[1]):
            low, high = x[rows, f].min(), x[rows, f].max()
            if low < high:
                cut = low + (high - low) * extra_trees.draw(seed, tree, at, f)
                left = x[rows, f] <= cut
                gain = y[rows][left].sum() ** 2 / left.sum() + y[rows][~left].sum() ** 2 / (~left).sum()
                if best is None or gain > best[0]:
                    best = gain, f, cut, left
        if best is None:
            return lambda row: mean
        _, f, cut, left = best
        below, above = node(2 * at, rows[left], level + 1), node(2 * at + 1, rows[~left], level + 1)
        return lambda row: below(row) if row[f] <= cut else above(row)
    return node(1, np.arange(len(y)), 0)


def test_extra_trees_equal_plain_ones(spark, table, tmp_path):
    pdf, df = table
    small = df.where("id < 150")
    rows = pdf[pdf.id < 150]
    x, y = rows[["a", "b"]].to_numpy(), rows.y.to_numpy()
    walks = [plain_tree(x, y, 9, t, 4) for t in range(3)]
    want = [np.mean([walk(row) for walk in walks]) for row in x]
    for parts in (1, 5):
        fitted = ExtraTreesRegressor(numTrees=3, maxDepth=4, seed=9).fit(small.repartition(parts))
        got = fitted.transform(small).orderBy("id").toPandas()
        assert np.allclose(got.prediction, want)
    fitted.write().overwrite().save(str(tmp_path / "trees"))
    again = ExtraTreesModel.load(spark, str(tmp_path / "trees")).transform(small).orderBy("id").toPandas()
    assert again.prediction.tolist() == got.prediction.tolist()


def test_extra_trees_of_little(spark):
    one = scale.assemble(spark.createDataFrame([(1, 2.0, 7.0)], "id int, a double, y double"), ["a"], "y", ["id"])
    assert ExtraTreesRegressor(numTrees=2).fit(one).transform(one).first()["prediction"] == 7.0
    with pytest.raises(ValueError, match="no rows"):
        ExtraTreesRegressor().fit(one.where("id = 2"))
