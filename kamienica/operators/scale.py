"""Splitting, scaling, power transform and principal components."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kamienica.operators.cleanse import quoted
from kamienica.session import settle

_HASH_SPACE = 2 ** 32
FARTHEST = 1e6  # no power is sought beyond


def key_hash(key: Column, seed: int) -> Column:
    """A number in [0, 2^32) that depends on the key and the seed only."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 123) -> tuple[DataFrame, DataFrame]:
    """(train, test); a row's side does not depend on partitions or on other rows."""
    is_test = key_hash(quoted(key), seed) < int(test_share * _HASH_SPACE)
    return df.where(~is_test), df.where(is_test)


def with_fold(df: DataFrame, key: str, folds: int = 5, seed: int = 123, name: str = "fold") -> DataFrame:
    return df.withColumn(name, F.pmod(key_hash(quoted(key), seed), F.lit(folds)).cast("int"))


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per column."""

    moments: dict[str, tuple[float, float]]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (quoted(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in self.moments.items()})


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Statistics of all columns in one pass; a column without spread is only centred."""
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.avg(quoted(c)).alias(f"m{i}"), F.stddev_pop(quoted(c)).alias(f"s{i}"))]).first()
    return Scaling({c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)})


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fit_scaling(df, columns).apply(df)


def yeo_johnson(value: Column, power: Column | float) -> Column:
    """The Yeo-Johnson transform (2000)."""
    power = F.lit(power) if isinstance(power, (int, float)) else power
    rest = F.lit(2.0) - power
    grown = F.when(F.abs(power) < 1e-12, F.log1p(value)).otherwise((F.pow(value + 1, power) - 1) / power)
    shrunk = F.when(F.abs(rest) < 1e-12, -F.log1p(-value)).otherwise(-(F.pow(1 - value, rest) - 1) / rest)
    return F.when(value >= 0, grown).otherwise(shrunk)


def _yeo_johnson_array(x: np.ndarray, power: float) -> np.ndarray:
    grown, shrunk = np.maximum(x, 0), np.maximum(-x, 0)
    up = np.log1p(grown) if abs(power) < 1e-12 else np.expm1(power * np.log1p(grown)) / power
    rest = 2 - power
    down = np.log1p(shrunk) if abs(rest) < 1e-12 else np.expm1(rest * np.log1p(shrunk)) / rest
    return up - down


def _power_moments(values: DataFrame, grids: Sequence[np.ndarray], means: Sequence[float]) -> DataFrame:
    """Count, log term and variance of every column under every power of its grid.

    Each batch of rows becomes one row of moments per column and power; Spark adds those up. Values are taken
    relative to the transformed mean, so that the sums do not cancel.
    """
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, grid in enumerate(grids):
                x = batch[f"x{i}"].dropna().to_numpy()
                if len(x):
                    logs = float(np.sum(np.sign(x) * np.log1p(np.abs(x))))
                    for j, power in enumerate(grid):
                        y = _yeo_johnson_array(x, power) - _yeo_johnson_array(means[i], power)
                        rows.append((i, j, len(x), logs, float(y.mean()), float(y.var() * len(x))))
            yield pd.DataFrame(rows, columns=["i", "j", "n", "logs", "mean", "m2"])

    parts = values.mapInPandas(moments, "i int, j int, n bigint, logs double, mean double, m2 double")
    return parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum("logs").alias("logs"),
        ((F.sum("m2") + F.sum(F.col("n") * F.col("mean") * F.col("mean"))
          - F.sum(F.col("n") * F.col("mean")) * F.sum(F.col("n") * F.col("mean")) / F.sum("n"))
         / F.sum("n")).alias("variance"))


def fit_powers(df: DataFrame, columns: Sequence[str], step: float = 1e-3) -> dict[str, float]:
    """Maximum-likelihood powers. Every pass scores a grid of powers for all columns, combined before the
    shuffle to one row per column and power, and then narrows each column's grid around its best. While the best
    lies at the edge of the grid the window moves there, twice as wide each time. From the finest grid, of at most `step`,
    the top of the parabola through the best three is taken. A column keeps power 1 if it has no spread or only two
    values (one power then gives the same as any other), or if no power has a finite score."""
    def number(c: str) -> Column:
        value = quoted(c).cast("double")
        return F.when(F.abs(value) < math.inf, value)  # neither NaN nor infinite

    fitted = dict.fromkeys(columns, 1.0)
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.min(number(c)).alias(f"a{i}"), F.max(number(c)).alias(f"z{i}"), F.avg(number(c)).alias(f"m{i}"))]).first()
    between = df.agg(F.lit(0), *[F.count_if((number(c) > row[f"a{i}"]) & (number(c) < row[f"z{i}"])).alias(f"b{i}")
                                 for i, c in enumerate(columns) if row[f"a{i}"] != row[f"z{i}"]]).first().asDict()
    means = {c: float(row[f"m{i}"]) for i, c in enumerate(columns) if between.get(f"b{i}")}
    grids = {c: np.linspace(-4.0, 4.0, 17) for c in means}
    values = settle(df.select(*[number(c).alias(f"x{i}") for i, c in enumerate(means)])) if means else df.limit(0)
    while any(g[1] > g[0] for g in grids.values()):
        scored = {(r["i"], r["j"]): r
                  for r in _power_moments(values, list(grids.values()), list(means.values())).collect()}
        for i, c in enumerate(means):
            grid, score = grids[c], []
            for j, power in enumerate(grid):
                row = scored.get((i, j))
                usable = row is not None and row["variance"] is not None and 0 < row["variance"] < math.inf
                score.append(-row["n"] / 2 * math.log(row["variance"]) + (power - 1) * row["logs"]
                             if usable else -math.inf)
            best, width = int(np.argmax(score)), grid[1] - grid[0]
            if width == 0:
                continue
            if score[best] == -math.inf or abs(grid[best]) > FARTHEST:
                grids[c] = np.array([fitted[c]] * 2)
            elif best in (0, len(grid) - 1):  # the optimum lies outside: move there, with twice the step
                grids[c] = grid[best] + 2 * width * (np.arange(len(grid)) - len(grid) // 2)
            elif width > step:
                grids[c] = np.linspace(grid[best] - width, grid[best] + width, 17)
            else:
                left, top, right = score[best - 1:best + 2]
                bend = left - 2 * top + right
                fitted[c] = float(grid[best] + (width * (left - right) / (2 * bend) if bend else 0.0))
                grids[c] = np.array([fitted[c]] * 2)
    return fitted


def power_transform(df: DataFrame, powers: dict[str, float], standardise: bool = True) -> DataFrame:
    """Apply fitted powers, then zero mean and unit variance."""
    changed = df.withColumns({c: yeo_johnson(quoted(c).cast("double"), p) for c, p in powers.items()})
    return standard_scale(changed, list(powers)) if standardise else changed


def assemble(df: DataFrame, columns: Sequence[str], label: str, keep: Sequence[str] = (),
             features: str = "features") -> DataFrame:
    """Feature vector and `label`, plus the columns of `keep`."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol=features).transform(df)
    return vectors.select(*[quoted(k) for k in keep], features, quoted(label).cast("double").alias("label"))


def pca_to_variance(train: DataFrame, test: DataFrame, share: float = 0.95,
                    features: str = "features") -> tuple[DataFrame, DataFrame, list[float]]:
    """Project on the fewest components that explain `share` of the variance, fitted on `train`.

    One fit over the written vectors yields all components; the wanted ones are kept. The fit centres by itself, and a
    projection of a row minus the projection of the mean is the projection of the centred row.
    """
    train, test = settle(train), settle(test)
    first = train.select(features).first()
    if first is None:
        raise ValueError("no rows to fit components on")
    width = len(first[0])
    fitted = PCA(k=width, inputCol=features, outputCol="_components").fit(train)
    ratios = [float(r) for r in fitted.explainedVariance.toArray()]
    k = min(int(np.argmax(np.cumsum(ratios) >= share - 1e-12)) + 1, width)
    mean = train.select(Summarizer.mean(F.col(features))).first()[0].toArray()
    loads = fitted.pc.toArray()[:, :k]
    shift = F.lit(mean @ loads)  # `width` numbers at most

    def project(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != features]
        values = F.slice(vector_to_array("_components"), 1, k)
        return fitted.transform(df).select(*kept, array_to_vector(
            F.zip_with(values, shift, lambda x, m: x - m)).alias(features))

    return project(train), project(test), ratios
