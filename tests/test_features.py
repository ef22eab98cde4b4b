import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kamienica.functions import rules
from kamienica.operators import encode, scale
from kamienica.plans.features import FeatureConfig, add_missing_category, build_features, impute_nulls, prepare_types

ROWS = [(5, "b"), (2, "c"), (9, "a"), (3, None), (7, "c"), (8, "d"), (1, "b")]


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame(ROWS, "id int, v string")


def codes(df):
    return {r["value"]: r["code"] for r in df.collect()}


@pytest.mark.parametrize("rows_per_range", [1, 2, 1000])
def test_dictionaries(letters, rows_per_range):
    assert codes(encode.ordinal_dictionary(letters, "v", rows_per_range)) == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert codes(encode.first_seen_dictionary(letters, "v", "id", "to_fill", rows_per_range)) == {
        "b": 0, "c": 1, "to_fill": 2, "d": 3, "a": 4}
    assert codes(encode.first_seen_dictionary(letters, "v", "id", None, rows_per_range))[None] == 2


def test_encode_decode(spark, letters):
    words = encode.ordinal_dictionary(letters, "v")
    coded = encode.encode(letters, "v", words)
    assert coded.columns == ["id", "v"] and dict(coded.collect()) == {5: 1, 2: 2, 9: 0, 3: None, 7: 2, 8: 3, 1: 1}
    assert sorted(encode.decode(coded, "v", words).collect()) == sorted(letters.collect())
    averaged = spark.createDataFrame([(1, 1.0), (2, 1.5)], "id int, v double")
    assert dict(encode.decode(averaged, "v", words).collect()) == {1: "b", 2: None}


def test_one_hot_drops_the_first(letters):
    got = encode.one_hot(letters, encode.categories(letters, ["v"]))
    assert got.columns == ["id", "v_b", "v_c", "v_d"]
    assert {r["id"]: tuple(r)[1:] for r in got.collect()} == {
        5: (1, 0, 0), 2: (0, 1, 0), 9: (0, 0, 0), 3: (0, 0, 0), 7: (0, 1, 0), 8: (0, 0, 1), 1: (1, 0, 0)}
    with pytest.raises(ValueError):
        encode.categories(letters, ["v"], limit=3)


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(20000)
    train, test = scale.hash_split(df, "id", 0.2, 123)
    again = scale.hash_split(df.repartition(7), "id", 0.2, 123)[1]
    assert train.count() + test.count() == 20000 and abs(test.count() - 4000) < 200
    assert test.subtract(again).count() == 0 and scale.hash_split(df, "id", 0.2, 5)[1].subtract(test).count() > 0
    folds = scale.with_fold(df, "id", 5).groupBy("fold").count().collect()
    assert len(folds) == 5 and all(abs(r["count"] - 4000) < 300 for r in folds)


def test_standard_scale(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (None, 7.0), (6.0, 7.0)], "x double, flat double")
    got = [tuple(r) for r in scale.standard_scale(df, ["x", "flat"]).collect()]
    std = np.std([1, 2, 6])
    assert got == [(pytest.approx(-2 / std), 0), (pytest.approx(-1 / std), 0), (None, 0), (pytest.approx(3 / std), 0)]


def likelihood(x, p):
    y = scale._yeo_johnson_array(x, p)
    return -len(x) / 2 * np.log(y.var()) + (p - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


def test_power_fit_is_the_maximum(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"skewed": rng.lognormal(0, 1, 3000), "normal": rng.normal(3, 2, 3000),
                        "left": -rng.gamma(2, 3, 3000), "flat": 2.0, "steep": rng.uniform(9.9, 10, 3000) ** 9 / 1e9})
    df = spark.createDataFrame(pdf).repartition(3)
    powers = scale.fit_powers(df, list(pdf))
    assert powers["flat"] == 1.0
    for c in ("skewed", "normal", "left", "steep"):
        x = pdf[c].to_numpy()
        near = powers[c] + np.linspace(-0.01, 0.01, 201)
        assert abs(near[np.argmax([likelihood(x, p) for p in near])] - powers[c]) <= 2e-4, c
    changed = scale.power_transform(df, powers).toPandas()
    assert np.allclose(changed["skewed"].mean(), 0, atol=1e-8) and np.allclose(changed["skewed"].std(ddof=0), 1)


@pytest.mark.parametrize("power", [-1.5, 0.0, 0.7, 1.0, 2.0, 3.0])
def test_power_column_equals_array(spark, power):
    x = np.array([-3.5, -0.1, 0.0, 0.2, 8.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = [r[0] for r in df.select(scale.yeo_johnson(F.col("x"), power)).collect()]
    assert got == pytest.approx(list(scale._yeo_johnson_array(x, power)))


def test_pca_keeps_the_share(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(0, 5, 400), rng.normal(0, 2, 400)
    pdf = pd.DataFrame({"id": range(400), "a": a + 100, "b": b, "c": a - b + rng.normal(0, .01, 400), "y": a})
    rows = scale.assemble(spark.createDataFrame(pdf), ["a", "b", "c"], "y", ["id"])
    train, test = scale.hash_split(rows, "id")
    projected, held_out, ratios = scale.pca_to_variance(train, test, 0.95)
    matrix = np.array([r["features"].toArray() for r in train.orderBy("id").collect()])
    centred = matrix - matrix.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(centred.T))
    assert ratios == pytest.approx(sorted(values / values.sum(), reverse=True), abs=1e-9)
    k = int(np.argmax(np.cumsum(ratios) >= 0.95)) + 1
    got = np.array([r["features"].toArray() for r in projected.orderBy("id").collect()])
    assert got.shape == (train.count(), k) and held_out.count() == test.count()
    want = centred @ vectors[:, ::-1][:, :k]
    assert np.allclose(np.abs(got), np.abs(want))


@pytest.fixture(scope="module")
def houses(spark):
    rng = np.random.default_rng(9)
    n = 300
    pdf = pd.DataFrame({"ad_id": range(n), "latitude": rng.uniform(50, 54, n), "longitude": rng.uniform(15, 23, n),
                        "area": rng.uniform(20, 120, n)})
    pdf["ad_price"] = pdf.area * 9000 + rng.normal(0, 1e4, n)
    pdf["metres"] = pdf.area * 1.001
    pdf["rok_budowy"] = rng.integers(1900, 2024, n).astype(float)
    pdf["rynek"] = rng.choice(["pierwotny", "wtórny"], n)
    pdf["okna"] = rng.choice(["drewniane", "plastikowe", "aluminiowe"], n)
    df = spark.createDataFrame(pdf)
    return df.withColumn("okna", F.when(F.col("ad_id") % 11 != 0, F.col("okna"))).withColumn(
        "rok_budowy", F.when(F.col("ad_id") % 7 != 0, F.col("rok_budowy"))).withColumn("empty", F.lit(None).cast("string"))


def test_impute_nulls_fills_everything(houses):
    rows = houses.drop("empty")
    on = ["latitude", "longitude", "ad_price"]
    filled = impute_nulls(rows, "ad_id", on).toPandas()
    assert len(filled) == 300 and not filled.isna().any().any()
    before, after = rows.toPandas().set_index("ad_id"), filled.set_index("ad_id").sort_index()
    known = before["okna"].notna()
    assert (after["okna"][known] == before["okna"][known]).all() and set(after["okna"]) == set(before["okna"].dropna())
    point, year = before[on].to_numpy(), before["rok_budowy"]
    for key in before.index[year.isna()][:10]:
        have = before.index[year.notna()]
        distance = np.sqrt(((point[have] - point[key]) ** 2).sum(axis=1))
        best = np.argsort(distance, kind="stable")[:5]
        weights = 1 / distance[best]
        assert after["rok_budowy"][key] == pytest.approx((year[have].to_numpy()[best] * weights).sum() / weights.sum())


def test_impute_as_codes(houses):
    got = impute_nulls(houses.select("ad_id", "latitude", "longitude", "ad_price", "rok_budowy"), "ad_id",
                       ["latitude", "longitude", "ad_price"], numbers_as_codes=True)
    assert dict(got.dtypes)["rok_budowy"] == "bigint" and got.where("rok_budowy is null").isEmpty()


@pytest.mark.parametrize("encoding, pca", [("one-hot", False), ("ordinal", True)])
def test_build_features(houses, encoding, pca):
    built = build_features(houses, FeatureConfig(key="ad_id", least_values_per_column=100, least_values_per_row=5,
                                                 encoding=encoding, pca=pca, power_transform=pca))
    # ad_price correlates with area before it; metres follows both, so it goes, and the target stays
    assert "metres" not in built.columns and "empty" not in built.columns and "ad_price" not in built.columns
    texts = ["rynek_wtorny", "okna_drewniane", "okna_plastikowe"] if encoding == "one-hot" else ["rynek", "okna"]
    assert set(built.columns) == {"latitude", "longitude", "area", "rok_budowy", *texts}
    total = built.train.count() + built.test.count()
    assert 290 <= total <= 300 and abs(built.test.count() - 60) < 30
    width = len(built.train.first()["features"])
    assert width == len(built.columns) if not pca else 1 <= width <= len(built.columns)
    assert built.train.columns == built.test.columns or set(built.train.columns) == set(built.test.columns)


def test_prepare_types(spark):
    row = {"powierzchnia": 50.0, "ktore_pietro": 2, "ile_pieter": "4 ", "liczba_pokoi": "3", "czynsz": "1 200,50",
           "rok_budowy": "1999", "dostepne_od": "2024-05-01", "adres": "a", "ad_photo": "p", "price_currency": "PLN"}
    df = spark.createDataFrame([tuple(row.values()), tuple({**row, "ktore_pietro": None}.values())],
                               "powierzchnia double, ktore_pietro int, ile_pieter string, liczba_pokoi string, czynsz string,"
                               "rok_budowy string, dostepne_od string, adres string, ad_photo string, price_currency string")
    got = prepare_types(df)
    assert got.count() == 1 and "adres" not in got.columns
    assert dict(got.dtypes) == {"powierzchnia": "double", "ktore_pietro": "bigint", "ile_pieter": "bigint",
                                "liczba_pokoi": "bigint", "czynsz": "double", "rok_budowy": "bigint", "dostepne_od": "date"}
    assert got.first()["ile_pieter"] == 4 and got.first()["czynsz"] == 1200.5


def test_missing_category(letters):
    assert add_missing_category(letters, "v").where(F.col("v") == rules.FILL_NONE).count() == 1
