import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kamienica.functions.keywords import Automaton
from kamienica.operators import cleanse, encode, gram, outliers


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.text("abż", max_size=3), max_size=3), st.sampled_from("xyz")), max_size=6),
       st.one_of(st.none(), st.text("abż ", max_size=12)))
def test_automaton_equals_searching_one_by_one(rules, text):
    want = None if text is None else next((v for words, v in rules if any(w in text for w in words)), None)
    assert Automaton({"c": rules, "none": []}).values_of(text) == [want, None]


def test_both_ways_of_backfilling_agree(spark):
    df = spark.createDataFrame([("do remontu ab", None, None), ("ab", "own", None), (None, None, "own"), ("", None, None),
                                ("żółw b", None, None)], "opis string, a string, `b c` string")
    rules = {"a": [(["remont", "żół"], "first"), (["ab"], "second")], "b c": [([], "never"), (["b", "do"], "some"), ([""], "any")]}
    one_by_one, automaton = (cleanse.backfill_from_text(df, "opis", rules, n) for n in (100, 0))
    assert automaton.columns == df.columns and one_by_one.collect() == automaton.collect()
    assert automaton.where("false").count() == 0


@pytest.mark.parametrize("tile, held", [(3, 1), (4, 5), (50, 2)])
def test_tiles_equal_all_pairs(spark, tile, held):
    rng = np.random.default_rng(tile)
    values = rng.normal(size=(200, 11)) @ rng.normal(size=(11, 11)) + rng.normal(size=11) * 50
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:, 4], values[5, 6] = 3.25, np.inf
    pdf = pd.DataFrame(values, columns=[f"c{i}" for i in range(11)])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                               ", ".join(f"c{i} double" for i in range(11))).repartition(3)
    clean = pdf.replace(np.inf, np.nan)
    want = clean.corr()
    got = gram.correlation_pairs(df, df.columns, tile, held).collect()
    assert sorted((r["i"], r["j"]) for r in got) == [(i, j) for i in range(11) for j in range(i + 1, 11)]
    for r in got:
        a, b = f"c{r['i']}", f"c{r['j']}"
        assert r["n"] == (clean[a].notna() & clean[b].notna()).sum()
        assert (r["r"] is None) if "c4" in (a, b) else r["r"] == pytest.approx(want.loc[a, b], abs=1e-9)


def test_correlated_columns_of_both_ways(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(100, 3))
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([base, base[:, :2] + rng.normal(0, .01, (100, 2)), -base[:, 2]]),
                                            columns=list("abcdef")))
    assert outliers.correlated_columns(df, 0.9) == outliers.correlated_columns(df, 0.9, narrow=1) == ["d", "e", "f"]


def test_passes_have_every_pair_once():
    for tiles, held in [(1, 1), (5, 3), (12, 24), (24, 24)]:
        found = [pair for group in gram.passes(tiles, held) for pair in group]
        assert sorted(found) == [(p, q) for p in range(tiles) for q in range(p, tiles)]
        assert max(map(len, gram.passes(tiles, held))) <= held


def test_no_rows_and_no_values(spark):
    empty = spark.createDataFrame([], "a double, b double, c double")
    assert all(r["r"] is None for r in gram.correlation_pairs(empty, empty.columns).collect())
    assert outliers.correlated_columns(empty, 0.5, narrow=0) == []


def test_positions_of_wide_texts_are_cut_by_short_keys(spark, monkeypatch):
    """Spark takes the keys it cuts ranges by to the driver, a hundred for each range."""
    calls, given = [], type(spark.range(1)).repartitionByRange

    def watched(df, ranges, *keys):
        widest = df.select(F.length(F.to_json(F.struct(*[F.col(k) if isinstance(k, str) else k for k in keys]))).alias("n"))
        calls.append((ranges, widest.agg(F.max("n")).first()[0]))
        return given(df, ranges, *keys)

    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", watched)
    monkeypatch.setattr(encode, "MOST_RANGES", 20)
    rows = spark.range(300).select(F.concat(F.sha2(F.col("id").cast("string"), 256), F.repeat(F.lit("x"), 20_000)).alias("t"))
    got = [r["t"] for r in encode.with_position(rows, ["t"], rows_per_range=5).orderBy("code").select("t").collect()]
    assert got == sorted(got) and len(got) == 300
    assert calls and all(ranges <= 20 and width < 200 for ranges, width in calls)


ALIKE = [("a" * n, "a" * m, i) for n in (0, 1, 63, 64, 65, 600) for m in (0, 64, 65, 70) for i in (1, 2)]


@pytest.mark.parametrize("per_range", [1, 7])
def test_positions_of_texts_that_start_alike(spark, per_range):
    rows = ALIKE + [(None, "z" * 80, 1), ("b", None, 3), ("ż" * 65, "", 1)] + [("x" * 3000 + f"{i:03d}", "", i) for i in range(90)]
    df = spark.createDataFrame(rows, "s string, t string, i int").repartition(5)
    got = encode.with_position(df, ["s", "t", "i"], rows_per_range=per_range).orderBy("code").collect()
    assert [r["code"] for r in got] == list(range(len(rows)))
    want = sorted(rows, key=lambda r: tuple((x is not None, x.encode() if isinstance(x, str) else x) for x in r))
    assert [(r["s"], r["t"], r["i"]) for r in got] == want
