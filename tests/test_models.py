import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression

from kamienica.operators import scale
from kamienica.operators.neighbours import KNNRegressor
from kamienica.plans import models


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(200), "a": rng.normal(size=200), "b": rng.normal(size=200)})
    pdf["y"] = 3 * pdf.a - 2 * pdf.b + rng.normal(0, .1, 200)
    return scale.assemble(spark.createDataFrame(pdf), ["a", "b"], "y", ["id"]).cache()


def test_every_model_trains(train):
    for name, estimator in models.regressors("id", trees=3, bags=2, depth=3, rounds=3, boosts=3).items():
        assert models.r2(estimator.fit(train).transform(train)) > 0.3, name


def test_compare_and_record(spark, train, tmp_path):
    chosen = {"LR": LinearRegression(), "KNN": KNNRegressor(keyCol="id", k=3)}
    runs = models.compare_models(train, chosen, "id", folds=3)
    scores = {r["name"]: r["mean_r2"] for r in models.leaderboard(spark, runs).collect()}
    assert scores["LR"] > 0.99 and 0.7 < scores["KNN"] < scores["LR"]
    models.record_runs(spark, runs, str(tmp_path))
    models.record_runs(spark, runs[:1], str(tmp_path))
    best = {r["name"]: (r["mean_r2"], r["runs"]) for r in models.best_runs(spark, str(tmp_path)).collect()}
    assert best["LR"] == (scores["LR"], 2) and best["KNN"] == (scores["KNN"], 1)
    assert (tmp_path / "models" / "LR").exists()


def test_fold_scores_equal_a_hand_written_loop(train):
    run = models.compare_models(train, {"LR": LinearRegression()}, "id", folds=3)[0]
    folded, scores = scale.with_fold(train, "id", 3), []
    for fold in range(3):
        fitted = LinearRegression().fit(folded.where(f"fold <> {fold}"))
        scores.append(models.r2(fitted.transform(folded.where(f"fold = {fold}"))))
    assert run.mean_r2 == pytest.approx(np.mean(scores))


def test_compared_rows_of_one_split_are_dealt_over_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(models, "settle", lambda df: seen.append(df.rdd.getNumPartitions()) or df)
    models.compare_models(spark.range(1000).coalesce(1), {}, "id")
    assert seen == [10]
