"""Principal components of many columns from a sketch: no square of the width, on the driver or in a task.

A seeded random matrix of `k` + `extra` columns is carried through the centred rows and back, `rounds` times; what comes out spans
the leading components. A last pass projects the rows on that span, and the components of the small projected table are
those wanted. Each pass is one scan in which a task adds up width x (k + extra) numbers; these meet row by row of the matrix
in one aggregate with partial sums. The driver orthogonalises the same matrix, whose size is checked.

Components beyond the rank of the table have no variance. With `k` of at least the width the result is exact; otherwise
the error falls with (next variance / variance) ** (2 * rounds).

Defined cases: rows without features take no part in the fit and have no projection; a table without rows is refused,
one of equal rows has no variance and ratios of zero; features of unlike width or values that are no numbers are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kamienica.operators.cleanse import quoted
from kamienica.session import settle

LARGEST = 1 << 22  # numbers in the carried matrix
BATCH = 1 << 21  # numbers of the rows a task holds as a matrix at a time


@dataclass(frozen=True)
class SketchPCA:
    mean: np.ndarray
    components: np.ndarray  # width x k
    variance: np.ndarray
    ratios: np.ndarray  # shares of the whole variance

    def transform(self, rows: DataFrame, features: str = "features", into: str = "projected") -> DataFrame:
        """Adds the coordinates of every row as an array."""
        shared = rows.sparkSession.sparkContext.broadcast((self.mean, self.components))  # checked by the fit

        @F.pandas_udf("array<double>")
        def project(vectors: pd.Series) -> pd.Series:
            mean, components = shared.value
            return pd.Series([None if v is None else (np.asarray(v, float) - mean) @ components for v in vectors], dtype=object)
        return rows.withColumn(into, project(_array(rows, features)))


def _array(rows: DataFrame, features: str) -> Column:
    kind = rows.schema[features].dataType
    return vector_to_array(quoted(features)) if isinstance(kind, VectorUDT) else quoted(features).cast("array<double>")


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        step = max(1, BATCH // width)
        for at in range(0, len(values), step):
            yield values[at:at + step]


def _carried(rows: DataFrame, mean: np.ndarray, span: np.ndarray, back: bool) -> np.ndarray:
    """The span through the centred rows: and back (width x columns), or the products of its columns with each other."""
    width, many = span.shape
    shared = rows.sparkSession.sparkContext.broadcast((mean, span))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, span = shared.value
        total = np.zeros((width if back else many, many))
        for matrix in _matrices(batches, width):
            centred = matrix - mean
            there = centred @ span
            total += (centred if back else there).T @ there
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), many).cast(
                pa.list_(pa.float64()))], names=["at", "sums"])

    added = rows.mapInArrow(run, "at long, sums array<double>").groupBy("at").agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(many)]).alias("sums"))
    found = added.toPandas().sort_values("at")
    return np.stack(found["sums"].to_numpy())


def fit(rows: DataFrame, k: int, features: str = "features", extra: int = 10, rounds: int = 2, seed: int = 123) -> SketchPCA:
    """The `k` components of the largest variance."""
    if k < 1 or extra < 0 or rounds < 1:
        raise ValueError("k and rounds are at least 1, extra is not negative")
    slim = settle(rows.select(_array(rows, features).alias("x")).where("x IS NOT NULL"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    facts = slim.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most"),
                     F.count_if(bad).alias("bad")).first()
    if not facts["n"] or not facts["most"]:
        raise ValueError("no rows to fit components on")
    if facts["least"] != facts["most"] or facts["bad"]:
        raise ValueError("features of unlike width, or values that are no numbers")
    n, width = facts["n"], facts["most"]
    many = min(width, k + extra)
    if width * many > LARGEST:
        raise ValueError(f"{width} columns times {many} is more than {LARGEST}")
    mean = _column_sums(slim, width, np.zeros(width))[0] / n
    squares = _column_sums(slim, width, mean)[1]
    span = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, many)))[0]
    for _ in range(rounds if many < width else 0):
        span = np.linalg.qr(_carried(slim, mean, span, True))[0]
    values, vectors = np.linalg.eigh(_carried(slim, mean, span, False))
    order = np.argsort(-values, kind="stable")[:min(k, many)]
    components = span @ vectors[:, order]
    # the largest load of a component is positive, so that a fit does not depend on chance signs
    components *= np.where(components[np.abs(components).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    found, whole = np.maximum(values[order], 0), squares.sum()
    return SketchPCA(mean, components, found / max(n - 1, 1), found / whole if whole else np.zeros(len(order)))


def _column_sums(rows: DataFrame, width: int, shift: np.ndarray) -> np.ndarray:
    """Sums and sums of squares of the shifted columns, a row each."""
    shared = rows.sparkSession.sparkContext.broadcast(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width))
        for matrix in _matrices(batches, width):
            off = matrix - shared.value
            total += off.sum(axis=0), np.einsum("ij,ij->j", off, off)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total[0]), pa.array(total[1])],
                                         names=["at", "one", "two"])
    added = rows.mapInArrow(run, "at long, one double, two double").groupBy("at").agg(
        F.sum("one").alias("one"), F.sum("two").alias("two"))
    return added.toPandas().sort_values("at")[["one", "two"]].to_numpy().T
