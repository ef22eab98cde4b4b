"""Profiles of a table that grows by snapshots: a state for each snapshot, states that merge, exact results from both.

The state of a snapshot holds, for each numeric column, one row a cell of values: cells are the 64ths of a doubling, by sign, so
that their number does not depend on the rows. A cell keeps its count, mean, squared deviations, lowest and highest value. For
each text column it holds one row a distinct value: its digest and count. Both merge by addition, so that a new snapshot costs
one pass over itself.

`describe` takes the merged state. Counts, moments, extremes, distinct and most frequent values come from it alone. Quantiles
are exact: the cell counts say in which cell a rank lies, and only rows between the ends of that cell are read, by filters that
reach the scan, cut into finer steps until one value is left. The text of the most frequent value is read from one snapshot.

Defined cases: nulls are counted apart; a column without values has count 0 and nulls elsewhere; NaN is above all numbers,
infinities have cells of their own; repeated rows count; with equal counts the value with the lowest digest is on top; a
snapshot taken twice counts twice; a null snapshot is one of its own; where squares leave the range of doubles the deviation is
not finite.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.operators.cleanse import quoted
from kamienica.operators.profile import numeric_columns, text_columns

STATE = ("snapshot string, column string, cell bigint, digest binary, n bigint, nulls bigint, mean double, m2 double, "
         "low double, high double")
PER_DOUBLING, MIDDLE = 64, 100_000  # the smallest double lies 1 074 doublings below 1
ENDLESS, NOT_A_NUMBER = 1 << 39, 1 << 40
FINER = 4096  # steps that a bracket is cut into in a pass


def cell_of(value: Column) -> Column:
    """The cell of a double; cells are in the order of the values in them."""
    size = F.floor(F.log2(F.abs(value)) * PER_DOUBLING) + MIDDLE
    return (F.when(F.isnan(value), F.lit(NOT_A_NUMBER))
            .when(value == math.inf, F.lit(ENDLESS)).when(value == -math.inf, F.lit(-ENDLESS))
            .when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size).cast("bigint"))


def snapshot_states(df: DataFrame, snapshot: Column, numbers: Sequence[str] | None = None,
                    texts: Sequence[str] | None = None) -> DataFrame:
    """The states of all snapshots in `df`, by default of all its numeric and text columns, in one pass for each kind."""
    numbers = numeric_columns(df) if numbers is None else list(numbers)
    texts = text_columns(df) if texts is None else list(texts)
    parts, of = [], snapshot.cast("string").alias("snapshot")
    if numbers:
        values = df.select(of, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), quoted(c).cast("double").alias("v")) for c in numbers])).alias("e"))
        values = values.select("snapshot", "e.*").withColumn("cell", F.when(F.col("v").isNotNull(), cell_of(F.col("v"))))
        parts.append(values.groupBy("snapshot", "column", "cell").agg(
            F.lit(None).cast("binary").alias("digest"), F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"),
            F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("low"), F.max("v").alias("high")))
    if texts:
        values = df.select(of, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.unhex(F.md5(quoted(c))).alias("digest")) for c in texts])).alias("e"))
        counted = values.select("snapshot", "e.*").groupBy("snapshot", "column", "digest").agg(F.count("*").alias("rows"))
        is_value = F.col("digest").isNotNull()
        nothing = F.lit(None).cast("double")
        parts.append(counted.select(
            "snapshot", "column", F.lit(None).cast("bigint").alias("cell"), "digest",
            F.when(is_value, F.col("rows")).otherwise(0).alias("n"), F.when(is_value, F.lit(0)).otherwise(F.col("rows")).alias("nulls"),
            nothing.alias("mean"), nothing.alias("m2"), nothing.alias("low"), nothing.alias("high")))
    if not parts:
        return df.sparkSession.createDataFrame([], STATE)
    states = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    return states.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(STATE).fields])


def merge(states: DataFrame) -> DataFrame:
    """One state from many, merged ones among them; `snapshot` becomes the first snapshot that has the cell or value."""
    same = Window.partitionBy("column", "cell", "digest")
    mean = F.sum(F.col("n") * F.col("mean")).over(same) / F.sum("n").over(same)
    cells = states.where("digest IS NULL AND n > 0").withColumn("middle", mean)
    apart = F.col("mean") - F.col("middle")
    sums = [F.sum("n").alias("n"), F.sum("nulls").alias("nulls")]
    merged = cells.groupBy("column", "cell", "digest").agg(
        F.min("snapshot").alias("snapshot"), *sums, F.first("middle").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"))
    rest = states.where("digest IS NOT NULL OR n = 0").groupBy("column", "cell", "digest").agg(
        F.min("snapshot").alias("snapshot"), *sums)
    names = [f.name for f in T._parse_datatype_string(STATE).fields]
    return merged.unionByName(rest, allowMissingColumns=True).select(*names)


@dataclass
class _Rank:
    """A wanted rank (from 0) of a column, the ends of the values it lies between, and how many values lie below them."""

    column: str
    rank: int
    low: float
    high: float
    below: int

    @property
    def found(self) -> bool:
        return self.low == self.high or math.isnan(self.low)


def _narrowed(rows: DataFrame, wanted: list[_Rank]) -> None:
    """Cut every bracket into steps and keep the one with the rank, until one value is left in each."""
    while open_ := [w for w in wanted if not w.found]:
        inside = [quoted(w.column).cast("double").between(w.low, w.high) for w in open_]
        any_ = inside[0]
        for condition in inside[1:]:
            any_ = any_ | condition
        steps = F.array_compact(F.array(*[
            F.when(condition, F.struct(F.lit(k).alias("k"), quoted(w.column).cast("double").alias("v"),
                                       F.floor((quoted(w.column).cast("double") - w.low) / (w.high - w.low) * FINER).alias("step")))
            for k, (w, condition) in enumerate(zip(open_, inside))]))
        counted = rows.where(any_).select(F.explode(steps).alias("e")).select("e.*").groupBy("k", "step").agg(
            F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()  # FINER + 1 a rank at most
        for k, w in enumerate(open_):
            _settle_on(w, sorted((r["step"], r["n"], r["low"], r["high"]) for r in counted if r["k"] == k))


def _settle_on(w: _Rank, cells: Sequence[tuple[int, int, float, float]]) -> None:
    for _, n, low, high in cells:
        if w.rank < w.below + n:
            w.low, w.high = low, high
            return
        w.below += n
    raise ValueError(f"the state of {w.column} does not belong to these rows")


def quantiles(state: DataFrame, rows: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of `rows`, whose merged state is `state`; exact."""
    cells: dict[str, list] = {c: [] for c in columns}
    for r in state.where(F.col("column").isin(list(columns)) & F.col("cell").isNotNull()).select(
            "column", "cell", "n", "low", "high").collect():  # a bounded number a column, whatever the rows
        cells[r["column"]].append((r["cell"], r["n"], r["low"], r["high"]))
    ranks: dict[tuple[str, int], _Rank] = {}
    for c, own in cells.items():
        own.sort()
        last = sum(n for _, n, *_ in own) - 1
        for share in shares if own else ():
            for rank in {math.floor(share * last), math.ceil(share * last)}:
                if (c, rank) not in ranks:
                    ranks[c, rank] = _Rank(c, rank, 0.0, 0.0, 0)
                    _settle_on(ranks[c, rank], own)
    _narrowed(rows, list(ranks.values()))

    def value(c: str, share: float) -> float | None:
        if not cells[c]:
            return None
        position = share * (sum(n for _, n, *_ in cells[c]) - 1)
        low, high = (ranks[c, at].low for at in (math.floor(position), math.ceil(position)))
        return low if low == high else low + (high - low) * (position - math.floor(position))
    return {c: [value(c, s) for s in shares] for c in columns}


def _tops(state: DataFrame, rows: DataFrame, snapshot: Column, texts: Sequence[str]) -> dict[str, Mapping]:
    """Count, distinct values, and the most frequent value with its count, by text column."""
    first = F.struct(-F.col("n"), F.col("digest"))
    found = {r["column"]: r.asDict() for r in state.where(F.col("column").isin(list(texts))).groupBy("column").agg(
        F.sum("n").alias("count"), F.count("digest").alias("unique"), F.max(F.when(F.col("digest").isNotNull(), F.col("n"))).alias("freq"),
        F.min_by("digest", F.when(F.col("digest").isNotNull(), first)).alias("digest"),
        F.min_by("snapshot", F.when(F.col("digest").isNotNull(), first)).alias("snapshot")).collect()}
    for c, top in found.items():
        top["top"] = None
        if top["digest"] is not None:
            holds = snapshot.cast("string").eqNullSafe(F.lit(top["snapshot"]))
            is_top = F.unhex(F.md5(quoted(c))) == F.lit(bytes(top["digest"]))
            top["top"] = rows.where(holds & is_top).select(quoted(c).alias("top")).first()["top"]
    return found


def describe(state: DataFrame, rows: DataFrame, snapshot: Column) -> DataFrame:
    """One row per column of the merged `state`, as `profile.describe_all` gives of `rows` without a state."""
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    of_numbers = state.where("digest IS NULL AND (cell IS NOT NULL OR n = 0)")
    middles = of_numbers.where("n > 0").groupBy("column").agg(mean.alias("middle"))
    apart = F.col("mean") - F.col("middle")
    moments = {r["column"]: r for r in of_numbers.where("n > 0").join(middles, "column").groupBy("column").agg(
        total.alias("count"), F.first("middle").alias("mean"),
        F.sqrt(F.sum(F.col("m2") + F.col("n") * apart * apart) / F.nullif(total - 1, F.lit(0))).alias("std"),
        F.min("low").alias("min"), F.max("high").alias("max")).collect()}
    columns = [r["column"] for r in state.select("column").distinct().collect()]
    types = dict(rows.dtypes)
    texts = [c for c in columns if types[c] == "string"]
    tops = _tops(state, rows, snapshot, texts) if texts else {}
    numbers = [c for c in columns if c not in texts]
    quartiles = quantiles(state, rows, numbers, [0.25, 0.5, 0.75]) if numbers else {}
    result = []
    for c in columns:
        if c in tops:
            top = tops[c]
            result.append((c, top["count"], top["unique"], top["top"], top["freq"], *[None] * 7))
        elif c in moments:
            m = moments[c]
            result.append((c, m["count"], None, None, None, m["mean"], m["std"], m["min"], *quartiles[c], m["max"]))
        else:
            result.append((c, 0, *[None] * 10))
    return rows.sparkSession.createDataFrame(
        result, "column string, count bigint, unique bigint, top string, freq bigint, mean double, std double, min double, "
                "q25 double, q50 double, q75 double, max double")
