import string

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kamienica.functions import rules, text


@pytest.mark.parametrize("given_text, folded", [
    ("Zażółć gęślą jaźń", "Zazolc_gesla_jazn"), ("ŁÓDŹ", "LODZ"), ("Balkon / ogród", "Balkon___ogrod"),
    ("m²,(a-b)", "m²,(a-b)"), ("ß ſ ø Þ œ Ĳ", "s_s_o_T_o_I"), ("Ľ Ĺ Ļ Ł ł ľ ĺ", "K_K_K_L_l_l_l"),
    ("ΑΒΓΔ ξψω ς", "ABGD_kpo_s"), ("Щука ёж", "SUKA_EZ"), ("საქართველო", "sakartvelo"), ("ῶἄᾏΐ", "oaAi"),
    ("×÷", "×÷"),
])
def test_fold(spark, given_text, folded):
    assert text.fold_name(given_text) == folded
    row = spark.createDataFrame([(given_text,)], "t string").select(text.fold_accents(F.col("t"))).first()
    assert row[0] == folded


def test_fold_nothing_is_null(spark):
    rows = spark.createDataFrame([("",), (None,)], "t string").select(text.fold_accents(F.col("t"))).collect()
    assert [r[0] for r in rows] == [None, None]


def test_table_is_one_to_one_in_length():
    assert len(text.ACCENTS_FROM) == len(text.ACCENTS_TO) == len(set(text.ACCENTS_FROM))
    assert set(text.ACCENTS_TO) <= set(string.ascii_letters + "_")


@given(st.text())
def test_folding_twice_changes_nothing(value):
    once = text.fold_name(value)
    assert text.fold_name(once) == once


@given(st.lists(st.text(max_size=4), max_size=8))
def test_safe_names_are_unique(names):
    got = text.safe_names(names, [f"c{i}" for i in range(len(names))])
    assert len({n.lower() for n in got}) == len(names) and all(got)


def test_safe_names_prefix_on_clash():
    assert text.safe_names(["winda", "Winda", ""], [None, "media", "media"]) == ["winda", "media_Winda", "media_"]


FLOORS = [("3/10", 3, "10"), ("parter/4", 0, "4"), ("> 10/15", None, "15"), ("Poddasze", 15, None),
          ("Suterena", -1, None), ("Zapytaj", None, None), ("2", 2, None), (None, None, None), ("1 2/3 x", 12, "3 x")]


@pytest.mark.parametrize("value, own, building", FLOORS)
def test_floors(spark, value, own, building):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(text.floor_number(F.col("t")), text.floors_in_building(F.col("t"))).first() == (own, building)


@pytest.mark.parametrize("value, plain, thousands", [
    ("54,3 m²", 54.3, 54.3), ("60 m²", 60.0, 60.0), ("1 200,50 m²", None, 1200.5), (None, None, None),
    ("duże", None, None)])
def test_area(spark, value, plain, thousands):
    df = spark.createDataFrame([(value,)], "t string")
    got = df.select(text.parse_number(F.col("t"), rules.AREA_UNIT),
                    text.parse_number(F.col("t"), rules.AREA_UNIT, True)).first()
    assert tuple(got) == (plain, thousands)


def test_rooms_and_rent(spark):
    df = spark.createDataFrame([("więcej niż 10", "1 200,50 zł"), ("3", "5 zł")], "r string, c string")
    got = df.select(text.room_count(F.col("r")), text.strip_unit(F.col("c"), rules.RENT_UNIT)).collect()
    assert [tuple(r) for r in got] == [("11", "1 200,50"), ("3", "5")]


def test_keywords_in_order_and_case_sensitive(spark):
    df = spark.createDataFrame([("x do zamieszkania, do remontu",), ("do wykonczenia",), ("Do Remontu",), (None,)], "t string")
    got = [r[0] for r in df.select(text.keyword_value(F.col("t"), rules.CONDITION_KEYWORDS)).collect()]
    assert got == ["do remontu", "do wykończenia", None, None]
