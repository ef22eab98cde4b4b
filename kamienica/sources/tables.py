"""Reading and writing the pipeline's tables: snapshots, Parquet, JSON lines, links, dead letters."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_rows(df: DataFrame, by: Column) -> DataFrame:
    """Rows of the newest snapshot. The maximum is one row, read once as a scalar subquery."""
    newest = df.agg(F.max(by).alias("newest")).scalar()
    return df.where(by == newest)


def latest_files(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """All rows of the most recently written folder of Parquet files under `path`, or of a file that stands alone.

    A snapshot is a folder with any number of parts, so files are grouped by the folder they lie in. `without` skips
    files whose path below `path` contains that text. Only the listing is read to choose.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select("path", "modificationTime")
    if without:
        files = files.where(~F.contains("path", F.lit(without)))
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    newest = (files.groupBy(folder.alias("folder")).agg(F.max("modificationTime").alias("time"))
              .orderBy(F.desc("time"), F.desc("folder")).limit(1).collect())
    if not newest:
        raise FileNotFoundError(f"no matching Parquet file under {path}")
    return spark.read.option("recursiveFileLookup", "false").parquet(newest[0]["folder"])


def latest_partition(spark: SparkSession, path: str, column: str = "snapshot") -> DataFrame:
    """Rows of the highest value of a partition column; the other partitions are not opened.

    The values come from the names of the partition folders: the file paths of the metadata column are read, no data
    column, and the filter on the one value found prunes all other partitions.
    """
    table = spark.read.parquet(path)
    pattern = f"[/]{re.escape(column)}=([^/]*)/"
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", pattern, 1).alias("name"))
    kind = table.schema[column].dataType
    value = F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))).cast(kind)
    newest = names.where((F.col("name") != "") & (F.col("name") != "__HIVE_DEFAULT_PARTITION__")).agg(F.max(value)).first()[0]
    return table.where(F.col(column) == F.lit(newest).cast(kind))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               drop: Iterable[str] = ()) -> DataFrame:
    """Parquet scan; dropped columns are never read from the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).drop(*drop)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines, aligned by name. With a schema nothing is inferred and unreadable lines are kept in
    `_corrupt_record`."""
    if schema is None:
        return spark.read.json(path)
    kept = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(kept).option("mode", "PERMISSIVE").json(path)


def write_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    """Add one snapshot to a partitioned raw table; repeating a snapshot replaces only that snapshot."""
    (df.withColumn("snapshot", F.lit(snapshot)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("snapshot").parquet(path))


def write_clean(df: DataFrame, path: str) -> None:
    """The cleansed table; an existing one is not touched."""
    df.write.mode("errorifexists").parquet(path)


def write_links(links: DataFrame, path: str) -> None:
    links.write.mode("errorifexists").parquet(path)


def read_links(spark: SparkSession, path: str, column: str = "link") -> DataFrame:
    """Distinct links of a link table."""
    return spark.read.parquet(path).select(column).distinct()


def write_failures(routed: DataFrame, path: str) -> None:
    """Rows with `status = 'failed'` to a dead-letter table, with the reason."""
    (routed.where(F.col("status") == "failed").select("page_id", "url", "status", "error")
           .write.mode("append").parquet(path))


def union_rows(*frames: DataFrame) -> DataFrame:
    """Row concatenation aligned by name; columns a frame lacks are null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
