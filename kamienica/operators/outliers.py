"""Row filters by spread and column filters by correlation.

Statistics are one row; they come to the driver and go back as constants of the next filter. The plan stays a
scan with a growing filter, however many rounds are run, and there is nothing to cache.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kamienica.operators import gram
from kamienica.operators.cleanse import quoted
from kamienica.operators.profile import DISTINCT_LIMIT, exact_quantiles, numeric_columns

_NOTHING = 1e-13  # a spread below this part of the square sum is rounding
NARROW = 8  # columns whose pairs are still a reasonable number of built-in aggregates


def inside_iqr(df: DataFrame, column: str, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Rows strictly between Q1 - 1.5·IQR and Q3 + 1.5·IQR."""
    q1, q3 = exact_quantiles(df, [column], [0.25, 0.75], distinct_limit)[column]
    if q1 is None:
        return df.where(F.lit(False))
    spread = q3 - q1
    value = quoted(column)
    return df.where((value > q1 - 1.5 * spread) & (value < q3 + 1.5 * spread))


def inside_zscore(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Rows whose population z-score is within `limit`; without any spread there is no score and no row."""
    mean, std = df.agg(F.avg(quoted(column)), F.stddev_pop(quoted(column))).first()
    if not std:
        return df.where(F.lit(False))
    return df.where(F.abs((quoted(column) - mean) / std) < limit)


def _zscore_scan(df: DataFrame, columns: list[str], limit: float = 3.0) -> tuple[DataFrame, list[str]]:
    """Applies the filters of `columns` up to the first that removes rows; returns what is still to be done."""
    names = list(dict.fromkeys(columns))
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[e for i, c in enumerate(names) for e in (
        F.avg(quoted(c)).alias(f"m{i}"), F.stddev_pop(quoted(c)).alias(f"s{i}"), F.count(quoted(c)).alias(f"n{i}"),
        F.min(quoted(c)).cast("double").alias(f"a{i}"), F.max(quoted(c)).cast("double").alias(f"z{i}"))]).first()
    for at, c in enumerate(columns):
        i = names.index(c)
        if not row[f"s{i}"]:
            return df.where(F.lit(False)), []
        mean, std = row[f"m{i}"], row[f"s{i}"]
        df = df.where(F.abs((quoted(c) - mean) / std) < limit)
        reach = max(abs((row[f"a{i}"] - mean) / std), abs((row[f"z{i}"] - mean) / std))
        if row[f"n{i}"] < row["rows"] or not reach < limit * (1 - 1e-9):
            return df, columns[at + 1:]
    return df, []


def drop_outliers(df: DataFrame, columns: Sequence[str], rounds: int, by_iqr: bool = False,
                  by_zscore: bool = True, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """`rounds` passes over the columns; every filter sees the statistics of what the one before left.

    With z-scores alone, one scan takes the statistics of all columns that are left; they stay right, and no new scan is
    needed, until a filter removes rows, which the extremes tell.
    """
    if by_zscore and not by_iqr:
        left = list(columns) * rounds
        while left:
            df, left = _zscore_scan(df, left)
        return df
    for _ in range(rounds):
        for column in columns:
            if by_iqr:
                df = inside_iqr(df, column, distinct_limit)
            if by_zscore:
                df = inside_zscore(df, column)
    return df


def _narrow_correlations(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """All pairs by built-in aggregates of one plan, without leaving the JVM."""
    rows = df.select(*[F.when(F.abs(quoted(c).cast("double")) < math.inf, quoted(c).cast("double")).alias(f"x{i}")
                       for i, c in enumerate(columns)])
    pairs = list(combinations(range(len(columns)), 2))
    wanted = [F.max(F.abs(f"x{i}")).alias(f"m{i}") for i in range(len(columns))]
    for i, j in pairs:
        a, b = F.col(f"x{i}"), F.col(f"x{j}")
        wanted += [F.covar_pop(a, b).alias(f"c{i}_{j}"), F.var_pop(F.when(b.isNotNull(), a)).alias(f"a{i}_{j}"),
                   F.var_pop(F.when(a.isNotNull(), b)).alias(f"b{i}_{j}")]
    row = rows.agg(*wanted).first()
    found: dict[tuple[str, str], float | None] = {}
    for i, j in pairs:
        spread_a, spread_b = row[f"a{i}_{j}"], row[f"b{i}_{j}"]
        value = None
        if spread_a is not None and spread_a > _NOTHING * row[f"m{i}"] ** 2 and spread_b > _NOTHING * row[f"m{j}"] ** 2:
            value = max(-1.0, min(1.0, row[f"c{i}_{j}"] / math.sqrt(spread_a * spread_b)))
        found[columns[i], columns[j]] = value
    return found


def correlations(df: DataFrame, columns: Sequence[str], narrow: int = NARROW) -> dict[tuple[str, str], float | None]:
    """Pearson correlation of every pair, in column order.

    Rows with a null, NaN or infinite value in a pair are left out of it; a pair without spread has no correlation. Up to
    `narrow` columns are built-in aggregates of one plan; more go tile by tile. The result is as large as the square of the
    columns; `correlated_columns` leaves it on the executors.
    """
    pairs = list(combinations(columns, 2))
    if not pairs:
        return {}
    if len(columns) <= narrow:
        return _narrow_correlations(df, columns)
    found: dict[tuple[str, str], float | None] = dict.fromkeys(pairs)
    for r in gram.correlation_pairs(df, columns).collect():
        found[columns[r["i"]], columns[r["j"]]] = r["r"]
    return found


def correlated_columns(df: DataFrame, ratio: float, columns: Sequence[str] | None = None, narrow: int = NARROW) -> list[str]:
    """Columns that correlate above `ratio`, in absolute terms, with any column before them."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    if len(columns) <= narrow:
        found = correlations(df, columns, narrow)
        return [c for c in columns if any(b == c and r is not None and abs(r) > ratio for (_, b), r in found.items())]
    pairs = gram.correlation_pairs(df, columns)
    late = {r["j"] for r in pairs.where(F.abs("r") > ratio).select("j").distinct().collect()}  # columns at most
    return [c for i, c in enumerate(columns) if i in late]


def drop_correlated(df: DataFrame, ratio: float, columns: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*correlated_columns(df, ratio, columns))
