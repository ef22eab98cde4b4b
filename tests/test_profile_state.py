import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kamienica.operators import profile, profile_state

ROWS = [(s, v, w, t) for s, part in enumerate([
    [(1.0, 5, "a"), (2.5, 5, "b"), (None, 7, "b"), (-3.0, 7, None)],
    [(0.0, 5, "c"), (1e150, 6, "b"), (-1e-200, 5, ""), (2.5, None, "c")],
    [(5e-324, 2 ** 40, "c"), (7.25, -9, "é" * 5000), (7.25, 0, "a")]]) for v, w, t in part]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "snap int, v double, `w w` bigint, t string")


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for c in want:
        for name, value in got[c].items():
            wanted = want[c][name]
            assert value == wanted or value == pytest.approx(wanted, rel=1e-9, nan_ok=True), (c, name)


def described(df, merged):
    return by_column(profile_state.describe(merged, df, F.col("snap")))


def test_merged_states_equal_a_rescan_in_any_order_of_merging(spark):
    df = frame(spark)
    want = by_column(profile.describe_all(df.drop("snap")).drop("earliest", "latest"))
    each = [profile_state.snapshot_states(df.where(F.col("snap") == s), F.col("snap"), ["v", "w w"], ["t"]) for s in range(3)]
    step = profile_state.merge(profile_state.merge(each[0].unionAll(each[1])).unionAll(each[2]))
    other = profile_state.merge(each[2].unionAll(profile_state.merge(each[1].unionAll(each[0]))))
    at_once = profile_state.merge(profile_state.snapshot_states(df, F.col("snap"), ["v", "w w"], ["t"]))
    for merged in (step, other, at_once):
        same(described(df, merged), want)


def test_only_brackets_are_read_and_filters_reach_the_scan(spark, tmp_path):
    rows = [(i % 3, float((i * 7919) % 5000), i, "x") for i in range(5000)]
    frame(spark, rows).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    state = profile_state.merge(profile_state.snapshot_states(df, F.col("snap"), ["v"], []))
    assert state.count() < 64 * 13
    narrow = df.where(F.col("v").between(2400, 2600))  # nothing outside the bracket is needed
    assert profile_state.quantiles(state, narrow, ["v"], [0.5]) == {"v": [2499.5]}
    with pytest.raises(ValueError, match="does not belong"):
        profile_state.quantiles(state, df.where("v < 100"), ["v"], [0.5])


def test_empty_nulls_infinities_and_one_row(spark):
    df = frame(spark, [(1, None, 3, None), (2, None, 3, None)])
    merged = profile_state.merge(profile_state.snapshot_states(df, F.col("snap"), ["v", "w w"], ["t"]))
    got = described(df, merged)
    assert got["v"]["count"] == 0 and got["v"]["q50"] is None and got["t"]["count"] == got["t"]["unique"] == 0
    assert got["w w"]["q25"] == got["w w"]["max"] == 3 and got["w w"]["std"] == 0
    none = profile_state.merge(profile_state.snapshot_states(df.limit(0), F.col("snap")))
    assert none.collect() == [] and described(df, none) == {}
    ends = frame(spark, [(1, v, 1, "x") for v in (math.inf, -math.inf, math.nan, 1.0, 2.0)])
    state = profile_state.merge(profile_state.snapshot_states(ends, F.col("snap"), ["v"], []))
    low, middle, top, last = profile_state.quantiles(state, ends, ["v"], [0.0, 0.5, 0.75, 1.0])["v"]
    assert (low, middle, top) == (-math.inf, 2.0, math.inf) and math.isnan(last)
    single = frame(spark, [(1, 4.0, 1, "x")])
    assert described(single, profile_state.merge(profile_state.snapshot_states(single, F.col("snap"))))["v"]["std"] is None


@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2, max_size=40))
@settings(max_examples=8, deadline=None)
def test_cells_are_in_the_order_of_values(spark, values):
    rows = spark.createDataFrame(pd.DataFrame({"v": values})).withColumn("cell", profile_state.cell_of(F.col("v")))
    cells = [r["cell"] for r in rows.orderBy("v").collect()]
    assert cells == sorted(cells)
