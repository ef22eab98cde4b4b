import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from __spark_entry__ import queries
from kamienica.operators import cleanse, dictionaries, sparse
from kamienica.plans.features import FeatureConfig, build_features

LISTS = [("a", "x, y, x", "u"), ("b", "", None), ("c", None, "v"), ("d", "y", "w"), ("e", "ż, x", "u"), ("f", "zz", "w")]


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(LISTS, "id string, list string, kind string")


def vocabulary(df):
    return cleanse.scan_vocabulary(df, {"list": "zz"})


@pytest.mark.parametrize("keep, binary, per_range", [(False, False, 10 ** 6), (True, True, 2), (True, False, 3)])
def test_vectors_equal_the_dense_columns(lists, keep, binary, per_range):
    words = cleanse.collect_vocabulary(vocabulary(lists))
    dense = cleanse.multi_hot(lists, ["list"], words, keep, binary)
    want = {r["id"]: [r[c] for c in dense.columns[2:]] for r in dense.collect()}
    dictionary = sparse.token_dictionary(vocabulary(lists), per_range)
    assert sorted((r["source"], r["token"], r["code"]) for r in dictionary.collect()) == [
        (s, t, i) for i, (s, t) in enumerate(words)]
    got = sparse.multi_hot(lists, "id", ["list"], dictionary, keep_null_lists=keep, binary=binary)
    assert got.columns == ["id", "kind", "tokens"]
    assert {r["id"]: r["tokens"].toArray().tolist() for r in got.collect()} == want


def test_one_hot_vectors(lists):
    dictionary = sparse.category_dictionary(lists, ["kind"])
    got = {r["id"]: r["categories"].toArray().tolist() for r in sparse.one_hot(lists, "id", ["kind"], dictionary).collect()}
    assert got == {"a": [0, 0], "b": [0, 0], "c": [1, 0], "d": [0, 1], "e": [0, 0], "f": [0, 1]}


def test_empty_tables(spark, lists):
    none = lists.where("id = 'q'")
    dictionary = sparse.token_dictionary(vocabulary(none))
    assert sparse.width(dictionary) == 0
    assert sparse.multi_hot(none, "id", ["list"], dictionary).count() == 0
    row = sparse.multi_hot(lists.where("id = 'a'"), "id", ["list"], dictionary).first()
    assert row["tokens"].size == 0


def test_a_hundred_thousand_tokens_become_features(spark):
    rows = spark.range(2000).select("id", F.expr("array_join(transform(sequence(0, 59), i -> concat('t', (id * 60 + i) "
                                                 "% 110000)), ', ')").alias("list"),
                                    (F.col("id") % 7).cast("double").alias("ad_price"))
    with pytest.raises(ValueError, match="sparse"):
        cleanse.collect_vocabulary(cleanse.scan_vocabulary(rows, {"list": None}))
    dictionary = sparse.token_dictionary(cleanse.scan_vocabulary(rows, {"list": None}))
    assert sparse.width(dictionary) == 110_000
    wide = sparse.multi_hot(rows, "id", ["list"], dictionary)
    vector = wide.where("id = 5").first()["tokens"]
    codes = {r["code"] for r in dictionary.where(F.col("token").isin([f"t{i}" for i in range(300, 360)])).collect()}
    assert vector.size == 110_000 and set(vector.indices.tolist()) == codes and set(vector.values.tolist()) == {1.0}
    built = build_features(wide, FeatureConfig(key="id", impute=None, by_zscore=False, drop_correlated=False,
                                               standard_scale=False, vectors=["tokens"]))
    assert built.train.first()["features"].size == 110_000 and built.columns == ["tokens"]


def test_build_features_beyond_the_limit_of_columns(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(300), "area": rng.uniform(20, 90, 300), "street": [f"s{i % 40}" for i in range(300)]})
    pdf["ad_price"] = 100 * pdf.area + 50.0 * (pdf.street == "s7")
    config = {"key": "id", "impute": None, "by_zscore": False, "drop_correlated": False}
    df = spark.createDataFrame(pdf)
    dense = build_features(df, FeatureConfig(**config))
    wide = build_features(df, FeatureConfig(**config, most_columns=20))
    assert len(dense.columns) == 40 and wide.columns == ["area", "_categories"] and wide.dictionary.count() == 39
    rows = [{r["id"]: r["features"].toArray().tolist() for r in b.train.collect()} for b in (dense, wide)]
    assert rows[0] == rows[1]
    fitted = LinearRegression(regParam=1e-6).fit(wide.train)
    assert fitted.summary.r2 > 0.99


def test_codes_stay_over_versions(spark, tmp_path):
    path = str(tmp_path / "codes")
    with pytest.raises(FileNotFoundError):
        dictionaries.read_dictionary(spark, path)
    first = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "row int, kind string")
    second = spark.createDataFrame([(0, "d"), (1, "a"), (2, "c"), (3, "d")], "row int, kind string")

    def codes(df):
        return {r["kind"]: (r["code"], r["version"]) for r in df.collect()}

    assert codes(dictionaries.extend_dictionary(first, path, 1, ["kind"], "row")) == {"b": (0, 1), "a": (1, 1)}
    want = {"b": (0, 1), "a": (1, 1), "d": (2, 2), "c": (3, 2)}
    for _ in range(2):  # a version done again comes out the same
        assert codes(dictionaries.extend_dictionary(second, path, 2, ["kind"], "row", rows_per_range=1)) == want
    nothing_new = dictionaries.extend_dictionary(first, path, 3, ["kind"], "row")
    assert codes(nothing_new) == want == codes(dictionaries.read_dictionary(spark, path))
    assert codes(dictionaries.read_dictionary(spark, path, 1)) == {"b": (0, 1), "a": (1, 1)}
    with pytest.raises(ValueError, match="builds on"):
        dictionaries.extend_dictionary(second, path, 1, ["kind"], "row")


def test_vectors_over_versions_only_get_longer(spark, lists, tmp_path):
    path = str(tmp_path / "tokens")
    early = lists.where("id < 'd'")
    old = dictionaries.extend_dictionary(vocabulary(early), path, 1, ["source", "token"])
    before = {r["id"]: r["tokens"] for r in sparse.multi_hot(early, "id", ["list"], old).collect()}
    new = dictionaries.extend_dictionary(vocabulary(lists), path, 2, ["source", "token"])
    after = {r["id"]: r["tokens"] for r in sparse.multi_hot(lists, "id", ["list"], new).collect()}
    assert sparse.width(new) > sparse.width(old)
    for key, vector in before.items():
        assert after[key].indices.tolist() == vector.indices.tolist() and after[key].values.tolist() == vector.values.tolist()


@pytest.mark.parametrize("size, per_sum", [(2 ** 20, 10 ** 6), (7, 10 ** 6), (4, 9), (1, 50)])
def test_column_sums_in_slices(spark, size, per_sum):
    rng = np.random.default_rng(6)
    rows = [(i, ", ".join(rng.choice([f"t{j:02d}" for j in range(30)], int(rng.integers(1, 9))))) for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(rows, "id int, list string")
    dictionary = sparse.token_dictionary(cleanse.scan_vocabulary(df, {"list": "t07"}))
    vectors = sparse.multi_hot(df, "id", ["list"], dictionary, keep_null_lists=True)
    dense = np.array([r["tokens"].toArray() for r in vectors.collect()])
    sums = sparse.column_sums(vectors, "tokens", size, per_sum)
    got = {r["code"]: (round(r["total"], 6), r["docs"]) for r in sums.collect()}
    assert got == {i: (dense[:, i].sum(), (dense[:, i] > 0).sum()) for i in range(dense.shape[1]) if dense[:, i].any()}
    assert sparse.column_sums(vectors.limit(0), "tokens", size, per_sum).count() == 0


def test_summed_vectors_are_not_held_whole(spark):
    """No task, and no broadcast from the driver, takes sums as wide as the dictionary."""
    plan = queries()["sparse_vectors"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "aggregate_metrics" in plan and "keys=[]" not in plan and "BroadcastHashJoin" not in plan
