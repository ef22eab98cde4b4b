import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kamienica.operators import network, scale
from kamienica.operators.network import NetworkModel, NetworkRegressor


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": range(600), "a": rng.normal(size=600), "b": rng.normal(size=600)})
    pdf["y"] = np.abs(pdf.a) * 3 - pdf.b + rng.normal(0, .05, 600)
    return pdf, scale.assemble(spark.createDataFrame(pdf), ["a", "b"], "y", ["id"])


def test_slopes_equal_differences_of_the_loss():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(20, 3)), rng.normal(size=20)
    flat = network.first_parameters(3, 5, 1)
    got, _ = network.slopes(x, y, flat, 0.3)
    for i in range(len(flat)):
        near = np.zeros(len(flat))
        near[i] = 1e-6
        want = (network.slopes(x, y, flat + near, 0.3)[1] - network.slopes(x, y, flat - near, 0.3)[1]) / 2e-6
        # Offsets are not weighed down, so the loss has no term for them.
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_passes_equal_a_plain_loop():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(7, 2)), rng.normal(size=7)
    flat = network.first_parameters(2, 3, 9)
    got, _ = network.passes(x, y, np.concatenate([flat, np.zeros(2 * len(flat))]), 0, 2, 3, 0.01, 1e-4)
    first, second, t = np.zeros(len(flat)), np.zeros(len(flat)), 0
    for _ in range(2):
        for rows in ([0, 1, 2], [3, 4, 5], [6]):
            t += 1
            g, _ = network.slopes(x[rows], y[rows], flat, 1e-4)
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            flat = flat - 0.01 * (1 - 0.999 ** t) ** 0.5 / (1 - 0.9 ** t) * first / (second ** 0.5 + 1e-8)
    assert np.allclose(got, np.concatenate([flat, first, second]))


def test_learns_what_no_line_can(table):
    _, df = table
    fitted = NetworkRegressor(hidden=32, eta=0.02, blockRows=200, batchRows=50, maxIter=12).fit(df)
    rows = fitted.transform(df).toPandas()
    assert 1 - ((rows.label - rows.prediction) ** 2).mean() / rows.label.var() > 0.95
    assert fitted.losses[-1] < fitted.losses[0] / 5


def test_same_for_any_partitions_nulls_and_saved(spark, table, tmp_path):
    _, df = table
    small = NetworkRegressor(hidden=4, blockRows=70, maxIter=2, passes=2)
    first, second = (small.fit(d) for d in (df.repartition(1), df.repartition(5)))
    assert first.parameters.tolist() == second.parameters.tolist()
    holes = df.unionByName(df.limit(2).withColumns({"id": F.col("id") + 1000, "label": F.lit(None).cast("double")}))
    assert small.fit(holes).parameters.tolist() == first.parameters.tolist()
    first.write().overwrite().save(str(tmp_path / "network"))
    again = NetworkModel.load(spark, str(tmp_path / "network"))
    pick = [m.transform(df).orderBy("id").toPandas().prediction.tolist() for m in (first, again)]
    assert pick[0] == pick[1]
    bare = df.limit(1).withColumn("features", F.when(F.lit(False), F.col("features")))
    assert first.transform(bare).first()["prediction"] is None


def test_refusals(table):
    with pytest.raises(ValueError, match="too many"):
        NetworkRegressor(hidden=network.MOST_PARAMETERS).fit(table[1])
    with pytest.raises(ValueError, match="no rows"):
        NetworkRegressor().fit(table[1].limit(0))
