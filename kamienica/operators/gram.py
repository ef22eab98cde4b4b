"""Sums of products of all pairs of many columns, tile by tile.

Columns are cut into tiles. A pass over the table takes a few pairs of tiles, reads only their columns, and keeps six small
matrices for each pair; every task hands over one row a pair, and rows of a pair are added up one at a time. So memory depends
on the tile and on how many pairs a pass takes, not on the number of columns or rows. A batch without any value in a tile
skips its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kamienica.operators.cleanse import quoted
from kamienica.session import settle

TILE, HELD = 128, 24  # columns of a tile; pairs of tiles in a pass
NOTHING = 1e-13  # a spread below this part of the square sum is rounding
MEANS = 500  # means in one aggregate
SUMS = "p int, q int, sums binary"
PAIRS = "i int, j int, n long, r double"


def finite(column: str) -> Column:
    value = quoted(column).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def means_of(df: DataFrame, columns: Sequence[str]) -> list[float]:
    """Mean of the finite values of each column, 0 where there are none."""
    found: list[float] = []
    for at in range(0, len(columns), MEANS):
        row = df.agg(*[F.avg(finite(c)).alias(f"m{i}") for i, c in enumerate(columns[at:at + MEANS])]).first()
        found += [m or 0.0 for m in row]
    return found


def passes(tiles: int, held: int) -> list[list[tuple[int, int]]]:
    """All pairs of tiles in groups of `held`, such that a group touches few tiles."""
    side = max(1, int(held ** 0.5))
    pairs = sorted(((p, q) for p in range(tiles) for q in range(p, tiles)), key=lambda t: (t[0] // side, t[1] // side, t))
    return [pairs[a:a + held] for a in range(0, len(pairs), held)]


def _sums(pairs: list[tuple[int, int]], spans: dict[int, slice]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            m = np.isfinite(x).astype(float)
            x = np.where(m > 0, x, 0.0)
            some = {t: m[:, span].any() for t, span in spans.items()}
            for p, q in pairs:
                if some[p] and some[q]:
                    a, b, ma, mb = x[:, spans[p]], x[:, spans[q]], m[:, spans[p]], m[:, spans[q]]
                    once = [ma.T @ mb, a.T @ mb, (a * a).T @ mb, a.T @ b]
                    other = [once[1].T, once[2].T] if p == q else [ma.T @ b, ma.T @ (b * b)]
                    new = np.stack([once[0], once[1], other[0], once[2], other[1], once[3]])
                    total[p, q] = new if (p, q) not in total else total[p, q] + new
        for (p, q), sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([q], pa.int32()), pa.array([sums.tobytes()])],
                                             names=["p", "q", "sums"])
    return run


def _correlations(tile: int, width: int):
    def close(p: int, q: int, sums: np.ndarray) -> pa.RecordBatch:
        n, a, b, aa, bb, ab = sums
        with np.errstate(divide="ignore", invalid="ignore"):
            spread_a, spread_b = aa - a * a / n, bb - b * b / n
            r = np.clip((ab - a * b / n) / np.sqrt(spread_a * spread_b), -1.0, 1.0)
        known = (n > 0) & (spread_a > NOTHING * aa) & (spread_b > NOTHING * bb)
        i, j = np.meshgrid(np.arange(n.shape[0]) + p * tile, np.arange(n.shape[1]) + q * tile, indexing="ij")
        use = i < j
        return pa.RecordBatch.from_arrays(
            [pa.array(i[use].astype(np.int32)), pa.array(j[use].astype(np.int32)), pa.array(n[use].astype(np.int64)),
             pa.array(r[use], mask=~known[use])], names=["i", "j", "n", "r"])

    def size(t: int) -> int:
        return min(tile, width - t * tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, sums = None, None
        for batch in batches:
            for p, q, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                new = np.frombuffer(data.as_buffer()).reshape(6, size(p), size(q))
                if (p, q) == pair:
                    sums = sums + new
                else:
                    if pair:
                        yield close(*pair, sums)
                    pair, sums = (p, q), new
        if pair:
            yield close(*pair, sums)
    return run


def correlation_pairs(df: DataFrame, columns: Sequence[str], tile: int = TILE, held: int = HELD) -> DataFrame:
    """(i, j, n, r), written: Pearson correlation of every pair of columns by their places, over the n rows that have both.

    Null, NaN and infinite values are left out pair by pair; a pair without spread has no correlation, a pair of tiles that no
    row has is missing.
    """
    columns = list(columns)
    means = means_of(df, columns)
    found = None
    for pairs in passes(-(-len(columns) // tile), held):
        tiles = sorted({t for pair in pairs for t in pair})
        places = [i for t in tiles for i in range(t * tile, min((t + 1) * tile, len(columns)))]
        spans, at = {}, 0
        for t in tiles:
            size = min(tile, len(columns) - t * tile)
            spans[t], at = slice(at, at + size), at + size
        rows = df.select(*[(finite(columns[i]) - F.lit(means[i])).alias(f"x{i}") for i in places])
        sums = rows.mapInArrow(_sums(pairs, spans), SUMS).repartition(len(pairs), "p", "q").sortWithinPartitions("p", "q")
        own = settle(sums.mapInArrow(_correlations(tile, len(columns)), PAIRS))
        found = own if found is None else found.unionAll(own)
    return found
