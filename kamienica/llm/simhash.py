"""SimHash near-duplicates through segment popcounts.

A fingerprint's 64 bits are read as 32 segments of two bits; the number of set bits of each is its embedding. Two
fingerprints never differ in fewer bits than their embeddings differ in Manhattan distance, so the range join runs over
embeddings. Its grid: the segments form six blocks, and within distance 3 at least three blocks have no difference at
all, so two near points share a cell in at least one of the 20 grids made of three blocks each. Within a cell the lower
bound, then the exact bit distance decides. Distinct fingerprints take part once, however many documents have them, and a
cell gives a spanning forest of its links, never all pairs. Forests of all cells are joined to components.

Defined cases: a null text is empty; texts without words have fingerprint 0, linked like any other; fewer words than a
shingle make one shingle; a component without any id has a null id; repeated rows belong to one component; an empty table
gives an empty result; input columns with the names of result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kamienica.llm.components import connected
from kamienica.session import settle

RESULT = ("fingerprint", "component_id")
BLOCKS = 6
HALF = 8192  # shingles whose bits are unpacked at a time
DENSE = 3000  # members of a cell above which it is cut by raw bits first
WIDTHS = (12, 12, 10, 10, 10, 10)  # bits of each block


def block_masks() -> list[int]:
    """Masks of the 20 choices of three blocks."""
    starts = np.concatenate([[0], np.cumsum(WIDTHS)])
    blocks = [((1 << w) - 1) << int(s) for w, s in zip(WIDTHS, starts)]
    return [a | b | c for a, b, c in combinations(blocks, 3)]


MASKS = np.array(block_masks(), np.uint64)
LOW = np.uint64(0x5555555555555555)


def embedding(fingerprints: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment, in the segment's place."""
    return fingerprints - ((fingerprints >> np.uint64(1)) & LOW)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of |difference| over 32 two-bit counts of 0 to 2: 0, 1 and 2 differ by 1 in an odd low bit, else by 2."""
    x = a ^ b
    low, high = x & LOW, (x >> np.uint64(1)) & LOW
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def fingerprint(text: str, width: int = 3) -> int:
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII blanks part words
    if not words:
        return 0
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - width + 1)
    set_bits = np.zeros(64, np.int64)
    for first in range(0, n, HALF):
        part = words[first:first + HALF + width - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(width)])) if len(part) >= width else [b" ".join(part)]
        hashes = np.array([digest(s, 42) for s in shingles], np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text") -> DataFrame:
    """Adds `__print`, the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn("__print", prints(F.coalesce(F.col(text), F.lit(""))))


def _forest(points: np.ndarray, most: int, out: list) -> None:
    """Spanning forest of the links among distinct fingerprints that share a cell, as arrays (from, to)."""
    if len(points) > DENSE:
        for mask in MASKS:  # links within `most` <= 3 raw bits have three raw blocks in common
            key = points & mask
            order = np.argsort(key, kind="stable")
            edges = np.flatnonzero(np.diff(key[order])) + 1
            for part in np.split(points[order], edges):
                if 1 < len(part) < len(points):
                    _forest(part, most, out)
                elif len(part) == len(points):
                    _reach(part, most, out)
        return
    _reach(points, most, out)


def _reach(points: np.ndarray, most: int, out: list) -> None:
    """Reaches from one point to all not yet reached within the distance, until none is left; each is left once."""
    while len(points) > 1:
        front, points = [points[0]], points[1:]
        while front and len(points):
            at = front.pop()
            near = manhattan(embedding(at[None]), embedding(points)) <= most
            near[near] = np.bitwise_count(points[near] ^ at) <= most
            if near.any():
                found = points[near]
                out.append((np.full(len(found), at), found))
                front.extend(found)
                points = points[~near]


def _cell_links(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell may go on in the next batch."""
        rest_cell, rest_point = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in _then_end(batches):
            if batch is not None:
                cells = np.concatenate([rest_cell, batch.column(0).to_numpy()])
                points = np.concatenate([rest_point, batch.column(1).to_numpy().view(np.uint64)])
                if not len(cells):
                    continue
                last = np.searchsorted(cells, cells[-1])
                rest_cell, rest_point = cells[last:], points[last:]
                cells, points = cells[:last], points[:last]
            else:
                cells, points = rest_cell, rest_point
            starts = np.flatnonzero(np.diff(cells)) + 1
            bounds = np.concatenate([[0], starts, [len(cells)]]) if len(cells) else np.zeros(1, np.int64)
            sizes, out = np.diff(bounds), []
            two = bounds[:-1][sizes == 2]  # most cells that have links at all
            a, b = points[two], points[two + 1]
            near = np.bitwise_count(a ^ b) <= most
            out.append((a[near], b[near]))
            for i in np.flatnonzero(sizes > 2):
                _forest(points[bounds[i]:bounds[i + 1]], most, out)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]).view(np.int64)) for k in (0, 1)],
                                             names=["u", "v"])
    return run


def _then_end(batches):
    yield from batches
    yield None


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = batch.column(0).to_numpy().view(np.uint64)
        spots = embedding(points)
        keys = (spots[:, None] & MASKS[None, :]) * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(MASKS), dtype=np.uint64)
        keys ^= keys >> np.uint64(29)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)),
                                          pa.array(np.repeat(points, len(MASKS)).view(np.int64))], names=["cell", "point"])


def links(points: DataFrame, most: int = 3) -> DataFrame:
    """(u, v): spanning forests, cell by cell, of the distinct fingerprints `point` that differ in `most` bits or fewer."""
    if most > 3:
        raise ValueError("the grid holds for distances up to 3")
    cells = points.select("point").mapInArrow(_cells, "cell long, point long")
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "point")
    return dealt.mapInArrow(_cell_links(most), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 3, key: str = "doc_id", text: str = "text",
                    row: Column | None = None) -> DataFrame:
    """(key columns `__key`, `__row`, `fingerprint`, `component_id`) of every document, and `stays` for one row key of
    each component. `__row` tells rows apart, by default those that have no id."""
    row = row if row is not None else F.coalesce(F.col(key).cast("string"), F.concat(F.lit("t"), F.md5(F.col(text))), F.lit("t"))
    slim = settle(fingerprints(docs.select(F.col(key).alias("__key"), row.alias("__row"), F.col(text).alias("__text")), width,
                               "__text").select("__key", "__row", "__print"))
    first = F.min(F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("id"), F.col("__row").alias("row")))
    points = settle(slim.groupBy(F.col("__print").alias("point")).agg(first.alias("first")))
    roots = connected(settle(links(points, most)))
    placed = points.join(roots, points["point"] == roots["node"], "left").withColumn("root", F.coalesce("root", "point"))
    best = placed.groupBy("root").agg(F.min("first").alias("best"))
    classes = settle(placed.join(best, "root").select(F.col("point").alias("__print"), "best"))
    bits = F.lower(F.lpad(F.hex("__print"), 16, "0"))
    return slim.join(classes, "__print").select("__key", "__row", bits.alias("fingerprint"),
                                                F.col("best.id").alias("component_id"),
                                                (F.col("best.row") == F.col("__row")).alias("stays"))


def drop_near_duplicates(docs: DataFrame, width: int = 3, most: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest id, of several with that id the one whose text has the least
    digest. Unlike texts under one id are documents of their own; rows equal in id and text are one. Columns stay as they are.
    """
    id_, body = F.col(key).cast("string"), F.col(text)
    row = F.md5(F.concat(F.when(id_.isNull(), "n").otherwise(F.concat(F.lit("k"), id_, F.lit(" "))),
                         F.when(body.isNull(), "n").otherwise(F.md5(body))))
    stays = near_duplicates(docs, width, most, key, text, row).where("stays").groupBy("__row").agg(F.count("*").alias("__rows"))
    met = docs.withColumn("__row", row).join(settle(stays), "__row")
    # only rows that occur twice are compared, and shuffled with their texts
    once, several = met.where("__rows = 1"), met.where("__rows > 1").dropDuplicates(["__row"])
    return once.unionAll(several).select(*docs.columns)
