"""Encodings of any width: rows of (code, count) and sparse vectors over a written dictionary, no column per value.

A dictionary has (source, token, code), codes from 0 without gaps; it can come from `token_dictionary` and
`category_dictionary`, or from a versioned one (`dictionaries.extend_dictionary` on source and token). Tokens are counted
inside their row, looked up by a join that Spark broadcasts only if the written dictionary is small, and gathered by row.
What a row's vector costs is its own tokens, not the width.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.functions.rules import LIST_SEPARATOR
from kamienica.operators import cleanse
from kamienica.operators.cleanse import quoted
from kamienica.operators.encode import ROWS_PER_RANGE, category_pairs, with_position
from kamienica.session import settle

WIDEST = 2 ** 31 - 1  # places a vector can have
SLICE = 2 ** 20  # places summed up at a time: a summary takes some 25 bytes for each
ROWS_PER_SUM = 1_000_000
PAIRS = "array<struct<code: bigint, n: bigint>>"


def token_dictionary(vocabulary: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(source, token, code) of a vocabulary of any size, in its order, written."""
    words = vocabulary.select("source", "token").distinct()
    return settle(with_position(words, ["source", "token"], rows_per_range=rows_per_range))


def category_dictionary(df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(source, token, code) of all values of the columns but the first of each, which stands for no entry."""
    pairs = settle(category_pairs(df, columns))
    first = pairs.groupBy("source").agg(F.min("token").alias("token"))
    return token_dictionary(pairs.join(first, ["source", "token"], "left_anti"), rows_per_range)


def width(dictionary: DataFrame) -> int:
    highest = dictionary.agg(F.max("code")).first()[0]
    size = 0 if highest is None else highest + 1
    if size > WIDEST:
        raise ValueError(f"a vector has at most {WIDEST} places, the dictionary {size}")
    return size


def pairs_by_key(long: DataFrame, key: str, dictionary: DataFrame) -> DataFrame:
    """(key, pairs) from (key, source, token, n): code and count by rising code. Tokens without a code fall away."""
    coded = long.join(dictionary.select("source", "token", "code"), ["source", "token"])
    return coded.groupBy(quoted(key)).agg(F.sort_array(F.collect_list(F.struct("code", "n"))).alias("pairs"))


def _with_pairs(df: DataFrame, long: DataFrame, key: str, dictionary: DataFrame, to: str) -> DataFrame:
    found = pairs_by_key(long, key, dictionary).select(quoted(key).alias("_of"), F.col("pairs").cast(PAIRS).alias("_pairs"))
    return df.join(found, quoted(key) == F.col("_of"), "left").select(
        *[quoted(c) for c in df.columns], F.coalesce("_pairs", F.array().cast(PAIRS)).alias(to))


def multi_hot_pairs(df: DataFrame, key: str, columns: Sequence[str], dictionary: DataFrame, keep_null_lists: bool = False,
                    binary: bool = False, separator: str = LIST_SEPARATOR, to: str = "tokens") -> DataFrame:
    """Replace list columns by one column of (code, count). Null lists and repeated tokens are dealt with as in
    `cleanse.multi_hot`; `key` is unique."""
    if not keep_null_lists:
        for column in columns:
            df = df.where(quoted(column).isNotNull())
    long = cleanse.token_counts(df, key, columns, separator)
    if binary:
        long = long.withColumn("n", F.lit(1).cast("bigint"))
    kept = df.drop(*columns)
    return _with_pairs(kept, long, key, dictionary, to)


def one_hot_pairs(df: DataFrame, key: str, columns: Sequence[str], dictionary: DataFrame, to: str = "categories") -> DataFrame:
    """Replace category columns by one column of (code, 1); null and the first value of a column have no entry."""
    long = category_pairs(df, columns, [key]).withColumn("n", F.lit(1).cast("bigint"))
    return _with_pairs(df.drop(*columns), long, key, dictionary, to)


def _sparse(size: int, indices: Column, values: Column) -> Column:
    """The parts of a sparse vector; written and read back as `VectorUDT`, they are one."""
    return F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"),
                    values.alias("values"))


def as_vectors(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Turn columns of (code, count) into sparse vectors of the given sizes.

    The table is written with the parts of the vectors and read back as vectors, so no row goes through Python.
    """
    def parts(pairs: Column, size: int) -> Column:
        return _sparse(size, F.transform(pairs, lambda p: p["code"].cast("int")),
                       F.transform(pairs, lambda p: p["n"].cast("double")))

    flat = df.select(*[parts(quoted(c), columns[c]).alias(c) if c in columns else quoted(c) for c in df.columns])
    kinds = T.StructType([T.StructField(f.name, VectorUDT()) if f.name in columns else f for f in df.schema.fields])
    return settle(flat, kinds)


def multi_hot(df: DataFrame, key: str, columns: Sequence[str], dictionary: DataFrame, to: str = "tokens",
              **how) -> DataFrame:
    """Replace list columns by one sparse count vector, as wide as the dictionary."""
    return as_vectors(multi_hot_pairs(df, key, columns, dictionary, to=to, **how), {to: width(dictionary)})


def one_hot(df: DataFrame, key: str, columns: Sequence[str], dictionary: DataFrame, to: str = "categories") -> DataFrame:
    """Replace category columns by one sparse indicator vector, as wide as the dictionary."""
    return as_vectors(one_hot_pairs(df, key, columns, dictionary, to), {to: width(dictionary)})


def _cut(size: int):
    """Cut the entries of every row where its places pass a multiple of `size`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, indices, values = batch.columns
            places, numbers = indices.flatten().to_numpy(), values.flatten()
            row = np.repeat(np.arange(len(own)), indices.value_lengths().to_numpy())
            of = places // size
            starts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(of, prepend=-1) != 0))
            ends = pa.array(np.append(starts, len(places)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [own.take(pa.array(row[starts])), pa.array(of[starts]), pa.ListArray.from_arrays(ends, pa.array(places % size)),
                 pa.ListArray.from_arrays(ends, numbers)], names=["part", "slice", "indices", "values"])
    return run


def column_sums(vectors: DataFrame, column: str, size: int = SLICE, rows_per_sum: int = ROWS_PER_SUM) -> DataFrame:
    """(code, total, docs): sum and number of entries other than zero of every place of sparse vectors that has an entry.

    Spark ML sums up dense, so the vectors are cut into slices of `size` places. A slice is summed over at most about
    `rows_per_sum` rows by one task; neither a task nor the driver ever holds the whole width.
    """
    parts = max(1, math.ceil(vectors.count() / rows_per_sum))
    whole = F.unwrap_udt(quoted(column))
    entries = vectors.select(F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int").alias("part"),
                             whole["indices"].alias("indices"), whole["values"].alias("values"))
    cut = entries.mapInArrow(_cut(size), "part int, slice int, indices array<int>, values array<double>")
    kinds = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("slice", T.IntegerType()),
                          T.StructField("entries", VectorUDT())])
    slices = settle(cut.select("part", "slice", _sparse(size, F.col("indices"), F.col("values")).alias("entries")), kinds)
    highest = slices.agg(F.max("slice")).first()[0] or 0
    # dealt by slice before anything is summed: what a task would add up beforehand is as wide as the slices it meets
    dealt = slices.repartition(parts * (highest + 1), "part", "slice").groupBy("part", "slice")
    sums = dealt.agg(Summarizer.metrics("sum", "numNonZeros").summary(F.col("entries")).alias("s"))
    places = sums.select("slice", F.posexplode(F.arrays_zip(
        vector_to_array("s.sum").alias("total"), vector_to_array("s.numNonZeros").alias("docs"))).alias("place", "z"))
    return places.where("z.docs > 0").groupBy((F.col("slice").cast("bigint") * size + F.col("place")).alias("code")).agg(
        F.sum("z.total").alias("total"), F.sum("z.docs").alias("docs"))
