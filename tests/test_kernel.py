import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kamienica.operators import kernel, scale
from kamienica.operators.kernel import FourierMap, KernelModel, KernelRegressor


def exact(gram, y, cost, epsilon, rounds=4000):
    """Kernel regression in its dual form, pair by pair of the multipliers that fit worst: f = gram @ beta + bias."""
    beta, slope = np.zeros(len(y)), -y.copy()  # slope of the smooth part: gram @ beta - y
    for _ in range(rounds * len(y)):
        up = np.where(beta < cost, slope + np.where(beta >= 0, epsilon, -epsilon), np.inf)
        down = np.where(beta > -cost, slope + np.where(beta > 0, epsilon, -epsilon), -np.inf)
        i, j = int(up.argmin()), int(down.argmax())
        if down[j] - up[i] < 1e-6:
            break
        bend = max(gram[i, i] + gram[j, j] - 2 * gram[i, j], 1e-12)
        step = min((down[j] - up[i]) / bend, cost - beta[i], beta[j] + cost)
        step = min([step] + [edge for edge in (-beta[i], beta[j]) if edge > 0])  # the loss bends where one is 0
        beta[i] += step
        beta[j] -= step
        slope += step * (gram[:, i] - gram[:, j])
    return gram @ beta - (up[i] + down[j]) / 2


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": range(160), "a": rng.normal(size=160), "b": rng.normal(size=160)})
    pdf["y"] = np.sin(2 * pdf.a) + 0.5 * pdf.b + rng.normal(0, .1, 160)
    return pdf, scale.assemble(spark.createDataFrame(pdf), ["a", "b"], "y", ["id"])



def test_inner_products_come_near_the_kernel():
    x = np.random.default_rng(1).normal(size=(50, 3))
    z = FourierMap(3, 1024, 0.4, 7).apply(x)
    want = np.exp(-0.4 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.15 and np.abs(z @ z.T - want).mean() < 0.03


def test_equals_the_exact_solution_on_its_map_and_comes_near_the_kernel(table):
    pdf, df = table
    x, y = pdf[["a", "b"]].to_numpy(), pdf.y.to_numpy()
    fitted = KernelRegressor(components=512, gamma=0.5, blockRows=50).fit(df)
    got = fitted.transform(df).orderBy("id").toPandas().prediction.to_numpy()
    z = FourierMap(2, 512, 0.5, 123).apply(x)
    assert np.allclose(got, z @ fitted.weights[:-1] + fitted.weights[-1])
    assert np.abs(got - exact(z @ z.T, y, 1.0, 0.1)).max() < 0.02
    whole = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    off = got - exact(whole, y, 1.0, 0.1)
    assert np.sqrt((off ** 2).mean()) < 0.1 and np.abs(off).max() < 0.4
    assert fitted.objectives == sorted(fitted.objectives, reverse=True) and len(fitted.objectives) < 100


def test_same_weights_for_any_partitions_nulls_and_saved(spark, table, tmp_path):
    _, df = table
    small = KernelRegressor(components=16, blockRows=30, maxIter=3)
    first, second = (small.fit(d) for d in (df.repartition(1), df.repartition(5)))
    assert first.weights.tolist() == second.weights.tolist()
    holes = df.unionByName(df.limit(2).withColumns({"id": F.col("id") + 1000, "label": F.lit(None).cast("double")}))
    assert small.fit(holes).weights.tolist() == first.weights.tolist()
    first.write().save(str(tmp_path / "kernel"))
    again = KernelModel.load(spark, str(tmp_path / "kernel"))
    pick = [m.transform(df).orderBy("id").toPandas().prediction.tolist() for m in (first, again)]
    assert pick[0] == pick[1]
    bare = df.limit(1).withColumn("features", F.when(F.lit(False), F.col("features")))
    assert first.transform(bare).first()["prediction"] is None


def test_refusals(table):
    with pytest.raises(ValueError, match="too many"):
        FourierMap(2, kernel.MOST_COMPONENTS + 1, 1.0, 0)
    with pytest.raises(ValueError, match="no rows"):
        KernelRegressor(gamma=1.0).fit(table[1].limit(0))
