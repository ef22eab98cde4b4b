"""Exact nearest neighbours between two tables, and what is built on them: imputation and regression.

The donors are cut into cells of bounded size: a cell that is too large is split at quantiles of the dimension
it is widest in (after Kamel/Leutenegger-style packing and k-d trees). A query first looks into its own cell. The
distance it gets there bounds the search, and only cells whose bounding box is within it are looked at next.
Nothing is capped: a cell is skipped only when it provably holds no nearer donor.

Cells are small tables joined by their path; which join is used is Spark's choice by size. Within a task, one
cell of donors meets one chunk of queries, so a crowded cell becomes many tasks rather than a long one. There, too,
only what may be near enough is measured: points of few dimensions are cut into leaves with boxes of their own, of
wider ones the squared distances are first taken from one matrix product, whose rounding is allowed for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.operators.cleanse import quoted
from kamienica.session import settle

# Cells are made about half this full. One that got larger is split again only when it holds several times as
# much: another level costs two more passes over the donors.
CELL_ROWS = 4096
_TOLERATED = 4
CHUNK_ROWS = 4096
_LEAF = 64
_BLOCK = 4_000_000  # numbers held at a time
_FAN = 64
# Cells up to this number are counted in a table of a few megabytes, which every executor may hold.
_FEW_CELLS = 100_000
_ROOT = "r"
_SLACK = 1 + 1e-9
# Up to this width the quantiles of all dimensions are taken in the pass that measures the boxes.
_NARROW = 4


@dataclass
class _Level:
    """One level of the cell tree: how its parents were split, and the boxes of all cells after the split."""

    splits: DataFrame | None
    boxes: DataFrame


def _quantiles(value: Column) -> Column:
    return F.percentile_approx(value, [i / _FAN for i in range(1, _FAN)], 1000)


def _boxes(points: DataFrame, width: int) -> DataFrame:
    """Size, bounds and widest dimension (`axis`) of every cell."""
    at = [F.col("point")[i] for i in range(width)]
    parts = [F.count(F.lit(1)).alias("n"), F.array(*[F.min(x) for x in at]).alias("low"),
             F.array(*[F.max(x) for x in at]).alias("high")]
    if width <= _NARROW:
        parts.append(F.array(*[_quantiles(x) for x in at]).alias("quantiles"))
    spreads = F.zip_with("high", "low", lambda h, l: h - l)
    return settle(points.groupBy("cell").agg(*parts).withColumn("widest", F.array_max(spreads))
                        .withColumn("axis", (F.array_position(spreads, F.col("widest")) - 1).cast("int")))


def _splits(points: DataFrame, crowded: DataFrame, width: int, cell_rows: int) -> DataFrame:
    """(cell, axis, cuts) of cells that hold too many rows: quantiles of the widest dimension.

    As many children as leave them half full. The midpoint is a cut as well, so that every split makes both
    sides smaller, whatever the values are.
    """
    if width <= _NARROW:
        measured = crowded.withColumn("q", F.get("quantiles", F.col("axis")))
    else:
        values = points.join(crowded.select("cell", "axis"), "cell").select(
            "cell", F.get("point", F.col("axis")).alias("x"))
        measured = crowded.join(values.groupBy("cell").agg(_quantiles(F.col("x")).alias("q")), "cell")
    low, high = F.get("low", F.col("axis")), F.get("high", F.col("axis"))
    middle = low / 2 + high / 2
    middle = F.when(middle < high, F.greatest(middle, low)).otherwise(low)
    children = F.least(F.ceil(F.col("n") * 2 / F.lit(cell_rows)), F.lit(_FAN))
    every = F.greatest(F.floor(F.lit(_FAN) / children), F.lit(1))
    chosen = F.filter("q", lambda _, i: (i + 1) % every == 0)
    cuts = F.filter(F.array_distinct(F.concat(chosen, F.array(middle))), lambda c: c < high)
    return measured.select("cell", "axis", cuts.alias("cuts"))


def _to_child(points: DataFrame, splits: DataFrame) -> DataFrame:
    """Move points of split cells to the child they fall into; other points stay."""
    columns = points.columns
    child = F.size(F.filter("cuts", lambda cut: F.get("point", F.col("axis")) > cut))
    joined = points.join(splits, "cell", "left")
    path = F.when(F.col("cuts").isNull(), F.col("cell")).otherwise(
        F.concat("cell", F.char(child + F.lit(ord("0")))))
    return joined.withColumn("cell", path).select(*columns)


def _grow(donors: DataFrame, width: int, cell_rows: int) -> tuple[DataFrame, list[_Level], int]:
    """Donors with their final cell, the levels of the tree, and the number of cells."""
    points = donors
    levels = [_Level(None, _boxes(points, width))]
    too_many = (F.col("n") > _TOLERATED * cell_rows) & (F.col("widest") > 0)
    while True:
        boxes = levels[-1].boxes
        cells, crowded = boxes.agg(F.count(F.lit(1)), F.count_if(too_many)).first()
        if not crowded:
            return points, levels, cells
        splits = _splits(points, boxes.where(too_many), width, cell_rows)
        splits = splits if width <= _NARROW else settle(splits)
        points = settle(_to_child(points, splits))
        levels.append(_Level(splits, _boxes(points, width)))


def _square_sum(terms: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for term in terms:
        total = total + term * term
    return total


def _farthest(width: int) -> Column:
    """Squared distance from `point` to the far corner of the box (low, high)."""
    return _square_sum([F.greatest(F.abs(F.col("point")[i] - F.col("low")[i]),
                                   F.abs(F.col("point")[i] - F.col("high")[i])) for i in range(width)])


def _nearest_edge(width: int) -> Column:
    """Squared distance from `point` to the box (low, high), 0 inside."""
    return _square_sum([F.greatest(F.col("low")[i] - F.col("point")[i],
                                   F.col("point")[i] - F.col("high")[i], F.lit(0.0)) for i in range(width)])


def _measured(at: np.ndarray, have: np.ndarray) -> np.ndarray:
    """Squared distances, one column of both after the other, so that all ways to get there round alike."""
    total = np.zeros(np.broadcast_shapes(at.shape, have.shape)[:-1])
    for i in range(at.shape[-1]):
        total += (at[..., i] - have[..., i]) ** 2
    return total


def _kth(d2: np.ndarray, k: int) -> np.ndarray:
    return np.partition(d2, k - 1, axis=1)[:, k - 1]


_Near = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _of_all(at: np.ndarray, have: np.ndarray, wanted: int, limit: np.ndarray) -> _Near:
    """(query, donor, squared distance) of the `wanted` nearest donors and of their equals, by blocks of queries. So do the
    two below; they leave out what is beyond the query's limit, and may find more."""
    rows = max(1, _BLOCK // len(have))
    for start in range(0, len(at), rows):
        d2 = _measured(at[start:start + rows, None], have[None])
        q, d = np.nonzero(d2 <= _kth(d2, wanted)[:, None])
        yield start + q, d, d2[q, d]


def _of_products(at: np.ndarray, have: np.ndarray, wanted: int, limit: np.ndarray) -> _Near:
    """|a - b|² = |a|² + |b|² - 2ab from a matrix product; what that cannot tell to be farther is measured."""
    middle = have.mean(axis=0)
    a, b = at - middle, have - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rounding = 8 * (at.shape[1] + 8) * np.finfo(float).eps * (
        np.sqrt(aa) + math.sqrt(bb.max()) + np.abs(middle).max() + np.abs(at).max(axis=1)) ** 2
    rows = max(1, _BLOCK // len(have))
    for start in range(0, len(at), rows):
        here = slice(start, start + rows)
        rough = a[here] @ b.T
        rough *= -2
        rough += bb
        bound = limit[here] - aa[here]
        loose = (rough <= (bound + rounding[here])[:, None]).sum(axis=1) > 4 * wanted
        if loose.any():
            bound[loose] = np.minimum(bound[loose], _kth(rough[loose], wanted) + rounding[here][loose])
        q, d = np.nonzero(rough <= (bound + rounding[here])[:, None])
        for part in range(0, len(q), rows * 64):
            qs, ds = start + q[part:part + rows * 64], d[part:part + rows * 64]
            yield qs, ds, _measured(at[qs], have[ds])


def _leaves(have: np.ndarray) -> np.ndarray:
    """Places of the points in leaves of `_LEAF`, halved again and again along the widest dimension; -1 where none is left."""
    halvings = math.ceil(math.log2(max(1.0, len(have) / _LEAF)))
    places = np.full((1, _LEAF * 2 ** halvings), -1)
    places[0, :len(have)] = np.arange(len(have))
    for _ in range(halvings):
        points = np.where(places[..., None] >= 0, have[places], np.nan)
        with np.errstate(invalid="ignore"):
            spread = np.fmax.reduce(points, axis=1) - np.fmin.reduce(points, axis=1)
        axis = np.nan_to_num(spread, nan=-1.0).argmax(axis=1)
        along = np.take_along_axis(points, axis[:, None, None], axis=2)[..., 0]
        order = np.argsort(along, axis=1, kind="stable")  # nan, no point, comes last
        places = np.take_along_axis(places, order, axis=1).reshape(2 * len(places), -1)
    return places[(places >= 0).any(axis=1)]


def _of_leaves(at: np.ndarray, have: np.ndarray, wanted: int, limit: np.ndarray) -> _Near:
    """Looks into the leaves whose box is within the limit, or as near as the donors of the nearest leaf."""
    places = _leaves(have)
    none = places < 0
    points = np.where(none[..., None], np.inf, have[places])
    low, high = points.min(axis=1), np.where(none[..., None], -np.inf, points).max(axis=1)
    full = (~none).sum(axis=1) >= wanted
    rows = max(1, _BLOCK // (4 * max(len(places), _LEAF)))
    for start in range(0, len(at), rows):
        block = at[start:start + rows]
        edge = np.zeros((len(block), len(places)))
        for i in range(at.shape[1]):
            x = block[:, i, None]
            edge += np.maximum(np.maximum(low[:, i] - x, x - high[:, i]), 0.0) ** 2
        home = np.where(full, edge, np.inf).argmin(axis=1)
        bound = np.minimum(limit[start:start + rows], _kth(_measured(block[:, None], points[home]), wanted))
        q, leaf = np.nonzero(edge <= (bound * _SLACK)[:, None])
        step = _BLOCK // (4 * _LEAF)
        for part in range(0, len(q), step):
            qs, ls = q[part:part + step], leaf[part:part + step]
            d2 = _measured(block[qs, None], points[ls])
            pair, nth = np.nonzero((d2 <= (bound * _SLACK)[qs, None]) & ~none[ls])
            yield start + qs[pair], places[ls[pair], nth], d2[pair, nth]


def _nearest_rows(at: np.ndarray, have: np.ndarray, wanted: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, donor, squared distance), by query and distance: up to `wanted` donors of each query, of equally near ones the
    first. Donors beyond a query's limit may be left out."""
    plain = np.isfinite(at).all() and np.isfinite(have).all() and max(np.abs(at).max(), np.abs(have).max()) < 1e150
    if not plain or len(have) <= 4 * max(_LEAF, wanted):
        ways = _of_all
    else:
        ways = _of_leaves if at.shape[1] <= _NARROW else _of_products
    q, d, d2 = (np.concatenate(parts) for parts in zip(*ways(at, have, wanted, limit), (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))))
    order = np.lexsort((d, d2, q))
    q, d, d2 = q[order], d[order], d2[order]
    near = np.arange(len(q)) - np.searchsorted(q, q) < wanted
    return q[near], d[near], d2[near]


def _search(visits: DataFrame, donors: DataFrame, width: int, k: int, few_cells: bool) -> DataFrame:
    """The k nearest donors of the visited cell, for every (query, cell) of `visits`; those beyond `limit2` may be
    left out."""
    axes = [f"x{i}" for i in range(width)]
    flat = [F.col("point")[i].alias(x) for i, x in enumerate(axes)]  # plain columns cross to Python faster
    chunks = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("chunks"))
    if few_cells:
        chunks = F.broadcast(chunks)
    asked = visits.select("query", "cell", "limit2", *flat).join(chunks, "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int")).drop("chunks")
    offered = donors.join(chunks, "cell").select(
        "donor", "value", "cell", *flat,
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def nearest_in_cell(queries: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or cell.empty:  # empty, in the types of the keys
            return pd.DataFrame({"query": queries["query"].iloc[:0], "donor": cell["donor"].iloc[:0],
                                 "value": np.zeros(0), "d2": np.zeros(0)})
        cell = cell.sort_values("donor", kind="stable")
        q, d, d2 = _nearest_rows(queries[axes].to_numpy(), cell[axes].to_numpy(), min(k, len(cell)), queries["limit2"].to_numpy())
        return pd.DataFrame({"query": queries["query"].to_numpy()[q], "donor": cell["donor"].to_numpy()[d],
                             "value": cell["value"].to_numpy()[d], "d2": d2})

    schema = T.StructType([
        T.StructField("query", visits.schema["query"].dataType),
        T.StructField("donor", donors.schema["donor"].dataType),
        T.StructField("value", T.DoubleType()), T.StructField("d2", T.DoubleType())])
    return asked.groupBy("cell", "chunk").cogroup(offered.groupBy("cell", "chunk")).applyInPandas(nearest_in_cell, schema)


def nearest(queries: DataFrame, donors: DataFrame, width: int, k: int = 5,
            cell_rows: int = CELL_ROWS) -> DataFrame:
    """The k nearest donors of every query by Euclidean distance; of equally near ones the lowest key first.

    queries(query, point), donors(donor, point, value); `point` is an array<double> of `width` numbers without
    nulls, keys are unique. Returns (query, donor, value, distance, place), place from 1.
    """
    # Both tables are written with their first cell: as a stored column it stays a join key, where a constant
    # would turn the joins below into cross joins.
    queries = settle(queries.select("query", F.col("point").cast("array<double>").alias("point"),
                                    F.lit(_ROOT).alias("cell")))
    # Of donors at one and the same point only the k lowest keys can ever be chosen.
    same_point = Window.partitionBy("point").orderBy("donor")
    donors = settle(donors.select("donor", F.col("point").cast("array<double>").alias("point"),
                                  F.col("value").cast("double").alias("value"), F.lit(_ROOT).alias("cell"))
                    .withColumn("_nth", F.row_number().over(same_point)).where(F.col("_nth") <= k).drop("_nth"))
    placed, levels, cells = _grow(donors, width, max(cell_rows, k))
    few_cells = cells <= _FEW_CELLS

    # Down the tree to the query's own cell; the smallest box with k donors bounds the distance.
    own = queries.withColumn("limit2", F.lit(float("inf")))
    for level in levels:
        if level.splits is not None:
            own = _to_child(own, level.splits)
        box = level.boxes.select("cell", "n", "low", "high")
        own = own.join(box, "cell", "left").withColumn(
            "limit2", F.when(F.col("n") >= k, F.least("limit2", _farthest(width))).otherwise(F.col("limit2"))
        ).drop("n", "low", "high")
    if len(levels) > 2:
        own = settle(own)
    found = _search(own.withColumn("limit2", F.lit(float("inf"))), placed, width, k, few_cells)

    if len(levels) > 1:
        found = settle(found)
        reached = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("d2"))
        alive = own.join(reached, "query", "left").select(
            "query", "point", F.col("cell").alias("own"), F.substring("cell", 1, 1).alias("cell"),
            (F.when(F.col("n") >= k, F.least("limit2", "d2")).otherwise(F.col("limit2")) * _SLACK).alias("limit2"))
        for depth, level in enumerate(levels[1:], start=1):
            parent = F.when(F.length("cell") > depth, F.expr(f"left(cell, {depth})")).otherwise(F.col("cell"))
            boxes = level.boxes.select(parent.alias("parent"), F.col("cell").alias("next"), "low", "high")
            alive = (alive.join(boxes, F.col("cell") == F.col("parent"))
                          .where(_nearest_edge(width) <= F.col("limit2"))
                          .select("query", "point", "own", F.col("next").alias("cell"), "limit2"))
        visits = settle(alive.where(F.col("cell") != F.col("own")))
        found = found.unionByName(_search(visits, placed, width, k, few_cells))

    best = Window.partitionBy("query").orderBy("d2", "donor")
    return (found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
                 .select("query", "donor", "value", F.sqrt("d2").alias("distance"), "place"))


def neighbour_mean(found: DataFrame, weights: str = "distance") -> DataFrame:
    """(query, value): mean of the neighbours' values, weighted by 1/distance or not at all.

    A neighbour at distance 0 has infinite weight: then only those at distance 0 count.
    """
    if weights == "uniform":
        return found.groupBy("query").agg(F.avg("value").alias("value"))
    here = F.avg(F.when(F.col("distance") == 0, F.col("value")))
    weight = F.when(F.col("distance") > 0, 1 / F.col("distance"))
    return found.groupBy("query").agg(
        F.coalesce(here, F.sum(F.col("value") * weight) / F.sum(weight)).alias("value"))


def neighbour_vote(found: DataFrame) -> DataFrame:
    """(query, value): the value with the largest total weight, the lowest of equals."""
    at_zero = F.max(F.when(F.col("distance") == 0, 1).otherwise(0)).over(Window.partitionBy("query"))
    weight = F.when(F.col("at_zero") == 1, F.when(F.col("distance") == 0, 1.0).otherwise(0.0)).otherwise(
        1 / F.col("distance"))
    votes = found.withColumn("at_zero", at_zero).withColumn("w", weight).groupBy("query", "value").agg(
        F.sum("w").alias("w"))
    return votes.groupBy("query").agg(F.min_by("value", F.struct(-F.col("w"), F.col("value"))).alias("value"))


def _patterns(df: DataFrame, on: Sequence[str]) -> list[tuple[bool, ...]]:
    """Which of the columns are present together; at most 2^len(on) rows."""
    return [tuple(r) for r in df.select(*[quoted(c).isNotNull().alias(f"p{i}") for i, c in enumerate(on)]).distinct().collect()]


def _has_pattern(on: Sequence[str], pattern: Sequence[bool]) -> Column:
    matches = F.lit(True)
    for c, has in zip(on, pattern):
        matches = matches & (quoted(c).isNotNull() if has else quoted(c).isNull())
    return matches


def knn_values(df: DataFrame, key: str, target: str, on: Sequence[str], k: int = 5, weights: str = "distance",
               mode: str = "mean", scale: bool = False, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query, value) for every row without `target`, from the k rows nearest in the columns `on`.

    Two rows are compared in the columns both have; the squared distance is then multiplied by the number of columns over
    the number compared. Every set of shared columns is a search of its own among the donors that share exactly it, and
    the k best of all searches count. Rows that share no column with any donor get the mean of the target.
    """
    known, gaps = df.where(quoted(target).isNotNull()), df.where(quoted(target).isNull())
    size = {c: 1.0 for c in on}
    if scale:
        row = df.agg(*[F.stddev_pop(quoted(c)).alias(f"s{i}") for i, c in enumerate(on)]).first()
        size = {c: row[f"s{i}"] or 1.0 for i, c in enumerate(on)}
    donor_patterns, found = _patterns(known, on), None
    for pattern in _patterns(gaps, on):
        here = gaps.where(_has_pattern(on, pattern))
        for shared in {tuple(a and b for a, b in zip(pattern, other)) for other in donor_patterns}:
            used = [c for c, has in zip(on, shared) if has]
            if not used:
                continue
            others = [o for o in donor_patterns if tuple(a and b for a, b in zip(pattern, o)) == shared]
            offers = F.lit(False)
            for other in others:
                offers = offers | _has_pattern(on, other)
            point = F.array(*[quoted(c).cast("double") / F.lit(size[c]) for c in used]).alias("point")
            part = nearest(here.select(quoted(key).alias("query"), point),
                           known.where(offers).select(quoted(key).alias("donor"), point, quoted(target).alias("value")),
                           len(used), k, cell_rows)
            part = part.withColumn("distance", F.col("distance") * F.sqrt(F.lit(len(on) / len(used))))
            found = part if found is None else found.unionByName(part)
    everyone = gaps.select(quoted(key).alias("query"))
    if found is None:
        values = everyone.withColumn("value", F.lit(None).cast("double"))
    else:
        best = Window.partitionBy("query").orderBy("distance", "donor")
        found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
        values = everyone.join(neighbour_vote(found) if mode == "vote" else neighbour_mean(found, weights), "query", "left")
    mean = known.agg(F.avg(quoted(target)).cast("double")).first()[0]
    return values.select("query", F.coalesce("value", F.lit(mean).cast("double")).alias("value"))


def knn_impute(df: DataFrame, key: str, target: str, on: Sequence[str], k: int = 5,
               weights: str = "distance", mode: str = "mean", truncate: bool = False,
               scale: bool = False, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Fill nulls of a numeric `target` by `knn_values`.

    `truncate` cuts imputed values to whole numbers; `mode="vote"` takes the weightiest value instead of the mean;
    `scale` divides each column of `on` by its deviation first. A column without any value stays as it is.
    """
    gaps = df.where(quoted(target).isNull())
    if gaps.isEmpty():
        return df
    kind = "bigint" if truncate else "double"
    known = df.where(quoted(target).isNotNull()).withColumn(target, quoted(target).cast(kind))
    values = knn_values(df, key, target, on, k, weights, mode, scale, cell_rows).withColumnsRenamed(
        {"query": "_query", "value": "_value"})
    imputed = gaps.join(values, quoted(key) == F.col("_query"), "left")
    return known.unionByName(imputed.select(*[
        F.col("_value").cast(kind).alias(c) if c == target else quoted(c) for c in df.columns]))


def knn_regress(train: DataFrame, test: DataFrame, key: str, point: str, label: str, width: int, k: int = 5,
                weights: str = "uniform", cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, prediction) for every row of `test` from its k nearest rows of `train`."""
    found = nearest(test.select(quoted(key).alias("query"), quoted(point).alias("point")),
                    train.select(quoted(key).alias("donor"), quoted(point).alias("point"),
                                 quoted(label).alias("value")), width, k, cell_rows)
    return neighbour_mean(found, weights).select(F.col("query").alias(key), F.col("value").alias("prediction"))


class _HasNeighbours(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    k = Param(Params._dummy(), "k", "number of neighbours", TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "unique key column", TypeConverters.toString)


class KNNRegressor(Estimator, _HasNeighbours):
    """k-nearest-neighbour regression as a Spark ML estimator, usable in `CrossValidator`."""

    @keyword_only
    def __init__(self, *, keyCol="id", featuresCol="features", labelCol="label",
                 predictionCol="prediction", k=5):
        super().__init__()
        self._setDefault(k=5, keyCol="id")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> KNNModel:
        return self._copyValues(KNNModel(dataset))


class _KNNWriter:
    """The training table as Parquet, the settings as one row beside it."""

    def __init__(self, model: KNNModel):
        self.model, self.mode = model, "errorifexists"

    def overwrite(self) -> _KNNWriter:
        self.mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        model = self.model
        model.train.write.mode(self.mode).parquet(f"{path}/train")
        row = [(p.name, str(model.getOrDefault(p))) for p in model.params if model.isDefined(p)]
        model.train.sparkSession.createDataFrame(row, "name string, value string").write.mode(self.mode).parquet(
            f"{path}/settings")


class KNNModel(Model, _HasNeighbours):
    """Holds the training table; the search runs when a table is transformed."""

    def write(self) -> _KNNWriter:
        return _KNNWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> KNNModel:
        model = KNNModel(spark.read.parquet(f"{path}/train"))
        for r in spark.read.parquet(f"{path}/settings").collect():
            model._set(**{r["name"]: int(r["value"]) if r["name"] == "k" else r["value"]})
        return model

    def __init__(self, train: DataFrame | None = None):
        super().__init__()
        self.train = train

    def copy(self, extra=None):
        other = super().copy(extra)
        other.train = self.train
        return other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, features = self.getOrDefault("keyCol"), self.getFeaturesCol()

        def points(df: DataFrame) -> DataFrame:
            return df.withColumn("_point", vector_to_array(features))

        first = self.train.select(features).first()
        predicted = knn_regress(points(self.train), points(dataset), key, "_point", self.getLabelCol(),
                                len(first[0]), self.getOrDefault("k"))
        return dataset.join(predicted.withColumnRenamed("prediction", self.getPredictionCol()), key, "left")
