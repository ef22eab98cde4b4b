import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kamienica.operators import neighbours
from kamienica.operators.neighbours import knn_impute, knn_regress, nearest


def brute(queries, donors, k):
    rows = []
    for q, at in queries:
        ranked = sorted((sum((a - b) ** 2 for a, b in zip(at, p)), d) for d, p in donors)[:k]
        rows += [(q, d, i + 1) for i, (_, d) in enumerate(ranked)]
    return sorted(rows)


def clouds(kind, n, width, seed):
    rng = np.random.default_rng(seed)
    if kind == "uniform":
        return rng.uniform(-5, 5, (n, width)).round(3)
    if kind == "hot":  # a third of the rows on one point, a third on one value of the first dimension
        points = rng.normal(0, 1, (n, width)).round(2)
        points[: n // 3] = 1.0
        points[n // 3: 2 * n // 3, 0] = 7.0
        return points
    if kind == "outlier":  # almost everything at one value, one far away
        points = np.zeros((n, width))
        points[:, -1] = rng.integers(0, 50, n)
        points[0, 0] = 1e9
        return points
    return rng.integers(0, 2, (n, width)).astype(float)  # indicators: many ties


@pytest.mark.parametrize("kind", ["uniform", "hot", "outlier", "indicator"])
@pytest.mark.parametrize("cell_rows", [16, 100000])
def test_equals_brute_force(spark, kind, cell_rows):
    have, ask = clouds(kind, 240, 3, 1), clouds(kind, 60, 3, 2)
    donors = [(i, [float(x) for x in p]) for i, p in enumerate(have)]
    queries = [(i, [float(x) for x in p]) for i, p in enumerate(ask)]
    q = spark.createDataFrame(queries, "query bigint, point array<double>")
    d = spark.createDataFrame([(i, p, float(i)) for i, p in donors],
                              "donor bigint, point array<double>, value double")
    got = nearest(q, d, 3, 4, cell_rows).select("query", "donor", "place").collect()
    assert sorted(map(tuple, got)) == brute(queries, donors, 4)


def test_fewer_donors_than_k_and_text_keys(spark):
    q = spark.createDataFrame([("a", [0.0]), ("b", [9.0])], "query string, point array<double>")
    d = spark.createDataFrame([("x", [1.0], 1.0), ("y", [8.0], 2.0)],
                              "donor string, point array<double>, value double")
    got = sorted(map(tuple, nearest(q, d, 1, 5).select("query", "donor", "distance", "place").collect()))
    assert got == [("a", "x", 1.0, 1), ("a", "y", 8.0, 2), ("b", "x", 8.0, 2), ("b", "y", 1.0, 1)]


ROWS = [
    (1, 10.0, 0.0, 0.0), (2, 20.0, 1.0, 0.0), (3, 30.0, 0.0, 3.0),
    (4, None, 0.0, 0.0),   # on top of row 1
    (5, None, 1.0, 3.0),
    (6, None, None, 0.0),  # compared in y only
    (7, None, None, None),  # the mean
]


def test_impute_mean(spark):
    df = spark.createDataFrame(ROWS, "id int, v double, x double, y double")
    got = {r["id"]: r["v"] for r in knn_impute(df, "id", "v", ["x", "y"], k=2).collect()}
    assert len(got) == 7
    assert got[1] == 10 and got[4] == 10
    # row 5: row 3 at distance 1, row 2 at distance 3
    assert got[5] == pytest.approx((30 / 1 + 20 / 3) / (1 + 1 / 3))
    assert got[6] == 15 and got[7] == 20


def test_impute_truncated_vote_and_scaled(spark):
    df = spark.createDataFrame(ROWS, "id int, v double, x double, y double")
    got = {r["id"]: r["v"] for r in knn_impute(df, "id", "v", ["x", "y"], k=2, truncate=True).collect()}
    assert got[5] == 27
    got = {r["id"]: r["v"] for r in knn_impute(df, "id", "v", ["x", "y"], k=2, mode="vote").collect()}
    assert got[5] == 30 and got[4] == 10
    scaled = {r["id"]: r["v"] for r in knn_impute(df, "id", "v", ["x", "y"], k=1, scale=True).collect()}
    assert scaled[4] == 10


def test_no_gaps_is_unchanged(spark):
    df = spark.createDataFrame(ROWS[:3], "id int, v double, x double, y double")
    assert knn_impute(df, "id", "v", ["x", "y"]).collect() == df.collect()


def test_regress(spark):
    pdf = pd.DataFrame({"id": range(60), "point": [[float(i % 7), float(i % 11)] for i in range(60)],
                        "label": [float(i) for i in range(60)]})
    df = spark.createDataFrame(pdf)
    train, test = df.where(F.col("id") >= 20), df.where(F.col("id") < 20)
    got = {r["id"]: r["prediction"] for r in knn_regress(train, test, "id", "point", "label", 2, 3).collect()}
    for i in range(20):
        ranked = sorted(((i % 7 - j % 7) ** 2 + (i % 11 - j % 11) ** 2, j) for j in range(20, 60))[:3]
        assert got[i] == pytest.approx(sum(j for _, j in ranked) / 3)


@pytest.mark.parametrize("kind", ["uniform", "hot", "outlier", "indicator"])
@pytest.mark.parametrize("width", [1, 2, 4, 5, 40])
def test_cell_search_measures_few_pairs(kind, width, monkeypatch):
    """The same rows as by measuring every pair of a cell, from a part of the pairs."""
    have, at = np.unique(clouds(kind, 1500, width, 3), axis=0), clouds(kind, 200, width, 4)
    d2 = ((at[:, None] - have[None]) ** 2).sum(axis=2) if width == 1 else sum((at[:, None, i] - have[None, :, i]) ** 2 for i in range(width))
    order = np.argsort(d2, axis=1, kind="stable")[:, :5]
    measured, given = [], neighbours._measured
    monkeypatch.setattr(neighbours, "_measured", lambda a, b: measured.append(given(a, b)) or measured[-1])
    for limit in (np.full(200, np.inf), np.take_along_axis(d2, order, axis=1)[:, -1]):
        measured.clear()
        k = min(5, len(have))
        q, d, got = neighbours._nearest_rows(at, have, k, limit)
        assert np.array_equal(q, np.repeat(np.arange(200), k)) and np.array_equal(d, order.ravel())
        assert np.array_equal(got, np.take_along_axis(d2, order, axis=1).ravel())
        if kind == "uniform":
            assert sum(m.size for m in measured) < 200 * len(have) / 2
