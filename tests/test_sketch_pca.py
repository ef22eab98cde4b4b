import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kamienica.operators import scale, sketch_pca


def spectrum(rows, width, seed=5):
    """Rows whose variances fall by a fixed share from component to component."""
    rng = np.random.default_rng(seed)
    turned = np.linalg.qr(rng.normal(size=(width, width)))[0]
    return rng.normal(size=(rows, width)) * 3 * 0.6 ** np.arange(width) @ turned + rng.normal(size=width) * 50


def exact(matrix):
    values, vectors = np.linalg.eigh(np.cov(matrix, rowvar=False))
    return values[::-1], vectors[:, ::-1]


@pytest.fixture(scope="module")
def wide(spark):
    matrix = spectrum(400, 60)
    return matrix, spark.createDataFrame(pd.DataFrame({"id": range(400), "features": [r.tolist() for r in matrix]})).repartition(5)


def test_ratios_equal_the_exact_ones(wide):
    matrix, df = wide
    values, vectors = exact(matrix)
    fitted = sketch_pca.fit(df, 5)
    assert np.allclose(fitted.ratios, values[:5] / values.sum(), atol=1e-6) and np.allclose(fitted.variance, values[:5], rtol=1e-5)
    assert np.allclose(np.abs((fitted.components * vectors[:, :5]).sum(axis=0)), 1, atol=1e-5)
    assert np.allclose(fitted.mean, matrix.mean(axis=0))


def test_projection_keeps_rows_and_columns(spark, wide):
    matrix, df = wide
    fitted = sketch_pca.fit(df, 3)
    more = df.unionByName(spark.createDataFrame([(1000, None)], df.schema))
    got = {r["id"]: r["projected"] for r in fitted.transform(more).collect()}
    assert got[1000] is None and len(got) == 401
    assert np.allclose([got[i] for i in range(400)], (matrix - matrix.mean(axis=0)) @ fitted.components)
    again = sketch_pca.fit(more.repartition(2), 3)
    assert np.allclose(again.components, fitted.components, atol=1e-9)


def test_all_components_are_exact(spark):
    matrix = spectrum(80, 6, 8)
    pdf = pd.DataFrame(matrix, columns=list("abcdef"))
    df = scale.assemble(spark.createDataFrame(pdf), list("abcdef"), "a")
    fitted = sketch_pca.fit(df, 10)
    assert fitted.components.shape == (6, 6) and np.allclose(fitted.ratios.sum(), 1)
    assert np.allclose(fitted.variance, exact(matrix)[0])


def test_defined_cases(spark):
    empty = spark.createDataFrame([], "features array<double>")
    flat = spark.createDataFrame([([1.0, 2.0],)] * 4, "features array<double>")
    assert sketch_pca.fit(flat, 1).ratios.tolist() == [0]
    for bad in (empty, flat.union(spark.createDataFrame([([1.0],)], "features array<double>")),
                flat.select(F.array(F.lit(1.0), F.lit(float("nan"))).alias("features"))):
        with pytest.raises(ValueError):
            sketch_pca.fit(bad, 1)
    with pytest.raises(ValueError):
        sketch_pca.fit(flat, 0)
