"""Profiling: null counts, description of every column, exact quantiles, re-typing, thresholds and fills."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.functions.text import parse_number
from kamienica.operators.cleanse import quoted

# Distinct values the exact `percentile` aggregate may hold in one task.
DISTINCT_LIMIT = 1_000_000
_ACCURACY = 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def long_form(row: DataFrame, measures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """A one-row frame turned into one row per column: measures = {column: {measure: expression}}."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(column).alias("column"), *[e.alias(m) for m, e in parts.items()])
        for column, parts in measures.items()
    ])).alias("_m")).select("_m.*")


def null_counts(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """(column, nulls) for columns that have any, counted in one pass."""
    counted = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    result = long_form(counted, {c: {"nulls": F.col(f"n{i}")} for i, c in enumerate(df.columns)})
    return result if all_columns else result.where(F.col("nulls") > 0)


def columns_with_nulls(df: DataFrame) -> list[str]:
    found = {r["column"] for r in null_counts(df).collect()}
    return [c for c in df.columns if c in found]


def table_info(df: DataFrame) -> DataFrame:
    """(column, non_null, type) of every column."""
    counted = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return long_form(counted, {
        c: {"non_null": F.col(f"n{i}"), "type": F.lit(kind)} for i, (c, kind) in enumerate(df.dtypes)})


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float],
                    distinct_limit: int = DISTINCT_LIMIT) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, exact at any size.

    Columns with few distinct values go through Spark's `percentile`, whose buffer grows with them. For the
    others a quantile sketch brackets each wanted rank; the bracket is counted and narrowed until few enough
    distinct values are left to be grouped and ranked.
    """
    sizes = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.count(quoted(c)).alias(f"n{i}"), F.approx_count_distinct(quoted(c)).alias(f"d{i}"),
        F.min(quoted(c)).cast("double").alias(f"lo{i}"), F.max(quoted(c)).cast("double").alias(f"hi{i}"))]).first()
    result: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    small = [c for i, c in enumerate(columns) if 0 < sizes[f"d{i}"] <= distinct_limit]
    if small:
        row = df.agg(*[F.percentile(quoted(c), list(shares)).alias(f"q{i}") for i, c in enumerate(small)]).first()
        result.update({c: list(row[f"q{i}"]) for i, c in enumerate(small)})
    targets = []
    for i, c in enumerate(columns):
        if sizes[f"d{i}"] > distinct_limit:
            for j, share in enumerate(shares):
                position = share * (sizes[f"n{i}"] - 1)
                for rank in {math.floor(position), math.ceil(position)}:
                    targets.append({"column": c, "share": j, "rank": rank, "position": position,
                                    "low": sizes[f"lo{i}"], "high": sizes[f"hi{i}"],
                                    "below": 0, "inside": sizes[f"n{i}"]})
    if targets:
        values = _ranked_values(df, targets, distinct_limit)
        for c in columns:
            for j in range(len(shares)):
                found = {t["rank"]: (values[k], t["position"]) for k, t in enumerate(targets)
                         if t["column"] == c and t["share"] == j}
                if found:
                    low, high = min(found), max(found)
                    start, position = found[low]
                    result[c][j] = start + (found[high][0] - start) * (position - low)
    return result


def _ranked_values(df: DataFrame, targets: list[dict], distinct_limit: int) -> list[float]:
    """The value at each target's rank (from 0): narrow every bracket, then rank what is left."""
    def inside(t: dict) -> Column:
        return quoted(t["column"]).cast("double").between(t["low"], t["high"])

    wide, margin = list(targets), 2 / _ACCURACY
    while wide:
        brackets = df.agg(*[
            F.percentile_approx(F.when(inside(t), quoted(t["column"]).cast("double")), [
                max(0.0, (t["rank"] - t["below"]) / t["inside"] - margin),
                min(1.0, (t["rank"] - t["below"] + 1) / t["inside"] + margin)], _ACCURACY).alias(f"b{k}")
            for k, t in enumerate(wide)]).first()
        measures = []
        for k, t in enumerate(wide):
            value, (low, high) = quoted(t["column"]).cast("double"), brackets[f"b{k}"]
            measures += [F.count_if(value < low).alias(f"below{k}"), F.count_if(value <= high).alias(f"upto{k}"),
                         F.approx_count_distinct(F.when(value.between(low, high), value)).alias(f"distinct{k}")]
        measured = df.agg(*measures).first()
        still_wide = []
        for k, t in enumerate(wide):
            below, upto = measured[f"below{k}"], measured[f"upto{k}"]
            # A bracket counts only if the rank is proven to lie in it.
            if below <= t["rank"] < upto and upto - below < t["inside"]:
                t.update(low=brackets[f"b{k}"][0], high=brackets[f"b{k}"][1], below=below, inside=upto - below)
                if measured[f"distinct{k}"] > distinct_limit and t["low"] < t["high"]:
                    still_wide.append(t)
        wide = still_wide

    pairs = F.array(*[F.when(inside(t), F.struct(F.lit(k).alias("k"),
                                                 quoted(t["column"]).cast("double").alias("v")))
                      for k, t in enumerate(targets)])
    grouped = (df.select(F.explode(F.array_compact(pairs)).alias("e")).select("e.*")
                 .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")))
    running = F.expr("sum(n) over (partition by k order by v)")
    wanted = F.element_at(F.array(*[F.lit(t["rank"] - t["below"]) for t in targets]), F.col("k") + 1)
    rows = (grouped.withColumn("upto", running).where(F.col("upto") > wanted)
                   .groupBy("k").agg(F.min("v").alias("v")).collect())
    by_target = {r["k"]: r["v"] for r in rows}
    return [by_target[k] for k in range(len(targets))]


def _number_rows(df: DataFrame, columns: Sequence[str], distinct_limit: int) -> DataFrame:
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], distinct_limit)
    moments = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.count(quoted(c)).alias(f"n{i}"), F.avg(quoted(c)).alias(f"m{i}"), F.stddev(quoted(c)).alias(f"s{i}"),
        F.min(quoted(c)).cast("double").alias(f"a{i}"), F.max(quoted(c)).cast("double").alias(f"z{i}"))])
    return long_form(moments, {c: {
        "count": F.col(f"n{i}"), "mean": F.col(f"m{i}"), "std": F.col(f"s{i}"), "min": F.col(f"a{i}"),
        **{name: F.lit(q).cast("double") for name, q in zip(("q25", "q50", "q75"), quartiles[c])},
        "max": F.col(f"z{i}")} for i, c in enumerate(columns)})


def _text_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values are counted by their digest, so that a shuffle moves 16 bytes per value however long the texts
    are; the text of the most frequent digest is then looked up, one constant per column."""
    digests = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.unhex(F.md5(quoted(c))).alias("digest")) for i, c in enumerate(columns)
    ])).alias("e")).select("e.*").where(F.col("digest").isNotNull())
    counted = digests.groupBy("i", "digest").agg(F.count(F.lit(1)).alias("n"))
    tops = {r["i"]: r for r in counted.groupBy("i").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"),
        F.min_by("digest", F.struct(-F.col("n"), F.col("digest"))).alias("top")).collect()}
    texts = df.agg(*[
        F.first(F.when(F.unhex(F.md5(quoted(c))) == F.lit(bytes(tops[i]["top"])), quoted(c)), ignorenulls=True)
        .alias(f"t{i}") if i in tops else F.lit(None).cast("string").alias(f"t{i}") for i, c in enumerate(columns)])
    return long_form(texts, {c: {
        "count": F.lit(tops[i]["count"] if i in tops else 0), "unique": F.lit(tops[i]["unique"] if i in tops else 0),
        "top": F.col(f"t{i}"), "freq": F.lit(tops[i]["freq"] if i in tops else None).cast("bigint")}
        for i, c in enumerate(columns)})


def describe_all(df: DataFrame, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """One row per column: count for all; unique, top, freq for text, dates, times and truth values; mean, std, quartiles
    for numbers; `earliest` and `latest`, as text, for dates and times. Of other types only the count is given.

    Quartiles are exact. Of equally frequent values the one with the lowest MD5 digest is `top`.
    """
    wanted = T._parse_datatype_string(
        "column string, count bigint, unique bigint, top string, freq bigint, mean double, std double, "
        "min double, q25 double, q50 double, q75 double, max double, earliest string, latest string")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    times = [c for c, k in kinds.items() if isinstance(k, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    numbers = numeric_columns(df)
    texts = [c for c, k in kinds.items() if isinstance(k, (T.StringType, T.BooleanType)) or c in times]
    others = [c for c in df.columns if c not in numbers and c not in texts]
    parts = [_number_rows(df, numbers, distinct_limit)] if numbers else []
    if texts:
        parts.append(_text_rows(df.select(*[quoted(c).cast("string").alias(c) for c in texts]), texts))
    if others:
        counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(others)])
        parts.append(long_form(counts, {c: {"count": F.col(f"n{i}")} for i, c in enumerate(others)}))
    if not parts:
        return df.sparkSession.createDataFrame([], wanted)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    if times:
        ends = df.agg(*[e for i, c in enumerate(times) for e in (
            F.min(quoted(c)).cast("string").alias(f"a{i}"), F.max(quoted(c)).cast("string").alias(f"z{i}"))])
        ends = long_form(ends, {c: {"earliest": F.col(f"a{i}"), "latest": F.col(f"z{i}")} for i, c in enumerate(times)})
        result = result.join(ends, "column", "left")
    return result.select(*[
        (F.col(f.name) if f.name in result.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wanted.fields])


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Re-type columns; text that does not fit becomes null. `unsigned` is a bigint that is not negative."""
    def cast(name: str, kind: str) -> Column:
        if kind == "unsigned":
            whole = quoted(name).try_cast("bigint")
            return F.when(whole >= 0, whole)
        if kind == "decimal comma":
            return parse_number(quoted(name), strip_thousands=True)
        return quoted(name).try_cast(kind)

    return df.withColumns({name: cast(name, kind) for name, kind in kinds.items()})


def drop_rows_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with a value in every column of `subset`, as conditions that reach the scan."""
    kept = df
    for name in subset:
        kept = kept.where(quoted(name).isNotNull())
    return kept


def drop_sparse_rows(df: DataFrame, least: int) -> DataFrame:
    """Rows with at least `least` values."""
    return df.na.drop(thresh=least)


def sparse_columns(df: DataFrame, least: int) -> list[str]:
    """Columns with fewer than `least` values."""
    return [r["column"] for r in table_info(df).where(F.col("non_null") < least).select("column").collect()]


def drop_sparse_columns(df: DataFrame, least: int) -> DataFrame:
    return df.drop(*sparse_columns(df, least))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constants for nulls, per column."""
    return df.na.fill(dict(values))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)
