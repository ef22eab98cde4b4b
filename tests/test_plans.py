"""Plans that must not change: no cross joins, no Python in cleansing, pruned scans."""

import pytest

from __spark_entry__ import queries

SMALL = "/root/testdata/sf0.001"
ROW_LOCAL = ["clean_listings", "multi_hot", "token_counts", "tokens_long", "links_filter", "fold_accents", "floor_numbers",
             "standard_scale", "outliers_two_rounds", "hash_split", "one_hot", "cast_date", "json_field", "zip_pairs"]
NEIGHBOURS = ["knn_impute_customers", "knn_regress"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_local(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert not [word for word in ("Exchange", "Join", "Python", "Pandas") if word in text]


@pytest.mark.parametrize("name", NEIGHBOURS)
def test_neighbours_have_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert "Cartesian" not in text and "NestedLoop" not in text and "FlatMapCoGroups" in text


def test_columns_are_pruned(spark):
    text = queries()["outliers_zscore"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_latest_rows_is_a_scalar_subquery(spark):
    text = plan(queries()["latest_snapshot"](spark, SMALL))
    assert "Subquery" in text and "Join" not in text
