"""Session helpers: building a local session and writing intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "kamienica", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` adds or replaces settings (dots as `__`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named in `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    shared = tempfile.mkdtemp(prefix="kamienica-")
    spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def settle(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write `df` to the shared folder once and read it back, by default with its own schema.

    Cuts the lineage, fixes values that a recomputation could change, survives lost executors, and gives
    Catalyst a real file size to choose join strategies by.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/kamienica-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
