"""Declared schemas of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from kamienica.functions import rules

_DOUBLES = {"ad_price", "latitude", "longitude"}

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

RAW_LISTINGS = T.StructType(
    [T.StructField("ad_id", T.StringType())]
    + [
        T.StructField(name, T.DoubleType() if name in _DOUBLES else T.StringType())
        for name in rules.LISTING_COLUMNS
    ]
)

RUNS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("mean_r2", T.DoubleType()),
    T.StructField("std_r2", T.DoubleType()),
    T.StructField("model_path", T.StringType()),
])
