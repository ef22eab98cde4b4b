"""Dictionaries that live longer than a snapshot: codes once given never move.

A dictionary is a folder of versions. Each version holds only the values it brought, numbered behind the highest code of the
versions before it, so a new snapshot costs its distinct values, one anti-join with the dictionary and a table of what is new.
Models, encoded tables and sparse vectors made with an older version stay valid: vectors only get longer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.operators.cleanse import quoted
from kamienica.operators.encode import ROWS_PER_RANGE, with_position


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_dictionary(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(values, code, version) as of a version, by default the newest; later versions are not opened."""
    found = _versions(spark, path)
    if found is None:
        raise FileNotFoundError(f"no dictionary under {path}")
    return found if version is None else found.where(F.col("version") <= version)


def extend_dictionary(df: DataFrame, path: str, version: int, on: Sequence[str], row_key: str | None = None,
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Give codes to the values of `on` that no earlier version has, and return the dictionary as of `version`.

    New values are numbered by their first appearance in `row_key` order, or without `row_key` in their own order. Values with
    a null in them get no code. A version that was broken off is done again with the same result, for it only builds on the
    versions before it; one that later versions build on is refused.
    """
    spark, on = df.sparkSession, list(on)
    known = _versions(spark, path)
    start = 0
    if known is not None:
        newest = known.agg(F.max("version")).first()[0]
        if newest is not None and newest > version:
            raise ValueError(f"version {newest} of {path} builds on version {version}")
        known = known.where(F.col("version") < version)
        start = (known.agg(F.max("code")).first()[0] or -1) + 1 if not known.isEmpty() else 0
    whole = F.lit(True)
    for column in on:
        whole = whole & quoted(column).isNotNull()
    values = df.where(whole)
    if row_key is None:
        seen, order = values.select(*[quoted(c) for c in on]).distinct(), list(on)
    else:
        seen = values.groupBy(*[quoted(c) for c in on]).agg(F.min(row_key).alias("_first"))
        order = ["_first", *on]
    if known is not None:
        seen = seen.join(known.select(*[quoted(c) for c in on]), on, "left_anti")
    numbered = with_position(seen, order, rows_per_range=rows_per_range)
    numbered.select(*[quoted(c) for c in on], (F.col("code") + start).alias("code")).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/version={version}")
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in on], T.StructField("code", T.LongType()),
                           T.StructField("version", T.IntegerType())])
    return spark.read.schema(schema).parquet(path).where(F.col("version") <= version)
