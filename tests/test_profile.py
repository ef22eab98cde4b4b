import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kamienica.operators import outliers, profile


@pytest.fixture(scope="module")
def gappy(spark):
    return spark.createDataFrame([(1, "a", 1.0, None), (2, None, 2.0, None), (3, "b", None, None), (None, "a", 4.0, "z")],
                                 "i int, t string, x double, w string")


def test_null_counts(gappy):
    assert {r["column"]: r["nulls"] for r in profile.null_counts(gappy).collect()} == {"i": 1, "t": 1, "x": 1, "w": 3}
    assert profile.columns_with_nulls(gappy.select("w", "i")) == ["w", "i"]
    assert profile.null_counts(gappy.where("i = 1").select("i"), all_columns=True).collect() == [("i", 0)]


def test_thresholds(gappy):
    assert {r["i"] for r in profile.drop_sparse_rows(gappy, 3).collect()} == {1, None}
    assert profile.drop_sparse_columns(gappy, 3).columns == ["i", "t", "x"]
    assert profile.drop_rows_missing(gappy, ["t", "x"]).count() == 2


def test_fill_and_casts(spark, gappy):
    assert {r["t"] for r in profile.fill(gappy, {"t": "to_fill"}).collect()} == {"a", "b", "to_fill"}
    df = spark.createDataFrame([("3", "-2", "1 200,5", "2024-05-01"), ("x", "7", "?", "soon")], "a string, b string, c string, d string")
    got = profile.cast_columns(df, {"a": "bigint", "b": "unsigned", "c": "decimal comma", "d": "date"})
    assert [tuple(map(str, r)) for r in got.collect()] == [("3", "None", "1200.5", "2024-05-01"), ("None", "7", "None", "None")]


def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(5, 2, 500), "n": rng.integers(0, 9, 500), "t": rng.choice(list("abc"), 500)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None))).withColumn("none", F.lit(None).cast("string"))
    want = pdf.describe(include="all").T
    for limit in (10, 10**6):
        got = {r["column"]: r for r in profile.describe_all(df, limit).collect()}
        for c in ("x", "n"):
            for mine, theirs in zip(("count", "mean", "std", "min", "q25", "q50", "q75", "max"),
                                    ("count", "mean", "std", "min", "25%", "50%", "75%", "max")):
                assert got[c][mine] == pytest.approx(want.loc[c, theirs])
        assert (got["t"]["count"], got["t"]["unique"], got["t"]["freq"]) == (500, 3, pdf.t.value_counts().max())
        assert (got["none"]["count"], got["none"]["unique"], got["none"]["top"]) == (0, 0, None)


@pytest.mark.parametrize("kind", ["distinct", "hot", "far"])
def test_bracketed_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(4)
    values = rng.normal(0, 1, 30000)
    if kind == "hot":
        values[:10000] = 0.25
    if kind == "far":
        values[:3] = [1e300, -1e300, 1e-300]
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    shares = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = profile.exact_quantiles(df, ["x"], shares, 20)["x"]
    assert got == pytest.approx(list(np.quantile(values, shares)))


def test_no_values_no_quantiles(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert profile.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert outliers.inside_iqr(df, "x").count() == 0


def test_iqr_and_rounds_equal_numpy(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1, 2000), rng.normal(0, 30, 60)])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    q1, q3 = np.quantile(values, [0.25, 0.75])
    kept = values[(values > q1 - 1.5 * (q3 - q1)) & (values < q3 + 1.5 * (q3 - q1))]
    assert outliers.inside_iqr(df, "x").count() == len(kept)
    left = values
    for _ in range(3):
        left = left[np.abs((left - left.mean()) / left.std()) < 3]
    filtered = outliers.drop_outliers(df, ["x"], 3)
    assert filtered.count() == len(left) < len(values)
    both = outliers.drop_outliers(df, ["x"], 1, by_iqr=True)
    assert both.count() == np.sum(np.abs((kept - kept.mean()) / kept.std()) < 3)


def test_rounds_leave_a_scan_with_filters(spark, capsys):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    outliers.drop_outliers(df, ["x"], 4).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan


def test_no_spread_leaves_no_row(spark):
    assert outliers.inside_zscore(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").count() == 0


@pytest.mark.parametrize("per_scan", [1, 100])
def test_drop_correlated(spark, per_scan):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=300), rng.normal(size=300)
    pdf = pd.DataFrame({"a": a, "b": b, "minus_a": -a + rng.normal(0, .1, 300), "c": a + b, "flat": 1.0})
    df = spark.createDataFrame(pdf)
    upper = pdf.corr().abs().where(np.triu(np.ones((5, 5)), k=1).astype(bool))
    want = [c for c in upper if (upper[c] > 0.6).any()]
    found = outliers.correlations(df, pdf.columns, per_scan)
    assert {k: v for k, v in found.items() if v is not None} == {
        k: pytest.approx(pdf[k[0]].corr(pdf[k[1]])) for k in found if "flat" not in k}
    assert outliers.correlated_columns(df, 0.6) == want
    assert outliers.drop_correlated(df, 0.6).columns == [c for c in pdf if c not in want]


def test_correlation_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1., 2, 3, 4, None, 6], "b": [2., 1, None, 3, 5, 9], "c": [1., 5, 2, 2, 0, 3]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double")
    for per_scan in (1, 100):
        found = outliers.correlations(df, ["a", "b", "c"], per_scan)
        assert found == {k: pytest.approx(pdf[k[0]].corr(pdf[k[1]])) for k in found}
