"""Category codes, their dictionaries, and indicator columns.

A dictionary is a DataFrame (value, code). It may be small or have billions of rows; joins with it are left to
Spark, which broadcasts it only when its real file size is under the session's threshold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.functions import text
from kamienica.operators.cleanse import MAX_COLUMNS, quoted
from kamienica.session import settle

ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 500  # of one shuffle
KEY_CHARS = 64  # characters of a text that ranges are cut by, at first
_SAMPLED = 100 * MOST_RANGES * KEY_CHARS  # characters that Spark looks at on the driver: a hundred rows a range
_LONG = 4  # a range is long if it has this many times the rows of the mean


def _shortened(df: DataFrame, order: Sequence[Column | str], chars: int) -> tuple[list[Column | str], Column]:
    """An order of the rows that looks at no more than `chars` characters of a text, and whether it leaves out any of a row.

    Rows in it are in the order given or equal: texts that go on come behind the one that ends there, and what would be
    compared after them is not looked at.
    """
    keys: list[Column | str] = []
    more = None
    for by in order:
        if isinstance(by, str) and df.schema[by].dataType == T.StringType():
            start, goes_on = F.substring(quoted(by), 1, chars), F.coalesce(F.length(quoted(by)) > chars, F.lit(False))
            keys += [start, goes_on] if more is None else [F.when(~more, start), F.when(~more, goes_on)]
            more = goes_on if more is None else more | goes_on
        elif more is None:
            keys.append(by)
        elif isinstance(by, str):
            keys.append(F.when(~more, quoted(by)))
        else:
            return keys, F.lit(True)
    return keys, F.lit(False) if more is None else more


def _ranges(rows: DataFrame, order: Sequence[Column | str], ranges: int, total: int) -> DataFrame:
    """The rows with the number of the range of the order they are in, written.

    Spark samples what it cuts by on the driver, so texts are shortened for it. Where many rows start alike a range gets long;
    then more of the texts is looked at, and as much fewer ranges are cut, as long as that makes the longest shorter.
    """
    chars = KEY_CHARS
    while True:
        keys, more = _shortened(rows, order, chars)
        cut = settle(rows.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id()))
        longest = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.count_if(more).alias("more")).orderBy(
            F.desc("n")).first()
        chars *= 8
        ranges = min(ranges, _SAMPLED // (100 * chars))
        if not longest["more"] or ranges < 2 or longest["n"] * ranges <= _LONG * total:
            return cut


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "code",
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number rows 0, 1, 2 … in the order given, which must be unique.

    Few rows are numbered by one window. More are cut into ranges of the order; each range is numbered on its
    own and shifted by the sizes of the ranges before it, so no task sees more than about one range, or than a part in
    `MOST_RANGES` of the rows.
    """
    rows = settle(df)
    total = rows.count()
    if total <= rows_per_range:
        return rows.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
    cut = _ranges(rows, order, min(math.ceil(total / rows_per_range), MOST_RANGES), total)
    sizes = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (cut.withColumn("_within", within).join(starts, "_range")
               .withColumn(name, (F.col("_start") + F.col("_within")).cast("bigint"))
               .drop("_range", "_within", "_start"))


def ordinal_dictionary(df: DataFrame, column: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(value, code): the values in sorted order from 0; null has no code."""
    values = df.where(quoted(column).isNotNull()).select(quoted(column).alias("value")).distinct()
    return with_position(values, ["value"], rows_per_range=rows_per_range)


def first_seen_dictionary(df: DataFrame, column: str, row_key: str, fill: object = None,
                          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(value, code): the values by their first appearance in `row_key` order; `fill` stands for null."""
    value = quoted(column) if fill is None else F.coalesce(quoted(column), F.lit(fill))
    seen = df.groupBy(value.alias("value")).agg(F.min(row_key).alias("_first"))
    return with_position(seen, ["_first"], rows_per_range=rows_per_range).drop("_first")


def encode(df: DataFrame, column: str, dictionary: DataFrame, to: str | None = None,
           fill: object = None) -> DataFrame:
    """Put the code of `column` into `to` (default: in place). Values not in the dictionary give null."""
    to = to or column
    value = quoted(column) if fill is None else F.coalesce(quoted(column), F.lit(fill))
    lookup = dictionary.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(lookup, value.eqNullSafe(F.col("_value")), "left")
    if to in df.columns:
        return joined.select(*[F.col("_code").alias(c) if c == to else quoted(c) for c in df.columns])
    return joined.select(*[quoted(c) for c in df.columns], F.col("_code").alias(to))


def decode(df: DataFrame, column: str, dictionary: DataFrame, to: str | None = None) -> DataFrame:
    """Back from codes to values; a code that is none (an average, say) gives null."""
    return encode(df, column, dictionary.select(F.col("code").alias("value"), F.col("value").alias("code")), to)


def category_pairs(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(`keep`, source, token): the values of several columns as text in one scan, distinct unless `keep` tells rows apart;
    null is no value."""
    pairs = df.select(*[quoted(k) for k in keep], F.explode(F.array(*[
        F.struct(F.lit(c).alias("source"), quoted(c).cast("string").alias("token")) for c in columns
    ])).alias("_e")).select(*[quoted(k) for k in keep], "_e.source", "_e.token").where(F.col("token").isNotNull())
    return pairs if keep else pairs.distinct()


def categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_COLUMNS) -> dict[str, list[str]]:
    """Sorted values of several columns from one scan; refuses more than `limit` in all."""
    rows = category_pairs(df, columns).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories; see operators.sparse for encodings of any width")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["source"]].append(row["token"])
    return {c: sorted(values) for c, values in found.items()}


def one_hot(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """Indicator columns for all values but the first; null is 0 everywhere. Names are folded and unique."""
    kept = [c for c in df.columns if c not in values]
    pairs = [(c, v) for c, column_values in values.items() for v in column_values[1:]]
    names = text.safe_names(kept + [f"{c}_{v}" for c, v in pairs])[len(kept):]
    return df.select(*[quoted(c) for c in kept], *[
        F.coalesce((quoted(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(n)
        for (c, v), n in zip(pairs, names)])


def multi_column_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordinal codes for several columns, in place."""
    for column in columns:
        df = encode(df, column, ordinal_dictionary(df, column))
    return df


def merge_on_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row-wise merge of two feature tables by their key."""
    return left.join(right, key, "inner")
