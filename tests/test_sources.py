import os
import time

import pytest
from pyspark.sql import functions as F

from kamienica.session import scratch_dir, settle
from kamienica.sources import tables


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "ą"), (2, None)], "id int, t string")


def test_json_round_trip_and_append(spark, df, tmp_path):
    path = str(tmp_path / "j")
    tables.append_json(df, path)
    tables.append_json(df.withColumn("extra", F.lit(1)), path)
    got = tables.read_json(spark, path)
    assert got.count() == 4 and set(got.columns) == {"id", "t", "extra"}
    typed = tables.read_json(spark, path, df.schema)
    assert [r["_corrupt_record"] for r in typed.collect()] == [None] * 4
    (tmp_path / "j" / "bad.json").write_text('{"id": 3\n{"id": 4, "t": "x"}\n')
    assert sum(r["_corrupt_record"] is not None for r in tables.read_json(spark, path, df.schema).collect()) == 1


def test_snapshots(spark, df, tmp_path):
    path = str(tmp_path / "raw")
    tables.write_snapshot(df, path, "2024-01-01")
    tables.write_snapshot(df.limit(1), path, "2024-02-01")
    tables.write_snapshot(df.limit(1), path, "2024-02-01")
    assert spark.read.parquet(path).count() == 3
    assert tables.latest_partition(spark, path).count() == 1
    assert tables.latest_rows(spark.read.parquet(path), F.col("snapshot")).count() == 1


def test_latest_partition_reads_one_partition(spark, df, tmp_path, capsys):
    path = str(tmp_path / "raw")
    for day in ("2024-01-01", "2024-02-01"):
        tables.write_snapshot(df, path, day)
    tables.latest_partition(spark, path).explain()
    assert "PartitionFilters: [isnotnull(snapshot" in capsys.readouterr().out


def test_latest_file(spark, df, tmp_path):
    for n, name in enumerate(["a", "b", "c_preprocessed"]):
        df.withColumn("n", F.lit(n)).coalesce(1).write.parquet(str(tmp_path / name))
        for file in (tmp_path / name).glob("*.parquet"):
            os.utime(file, (time.time() + n, time.time() + n))
    assert tables.latest_files(spark, str(tmp_path), without="preprocessed").first()["n"] == 1
    assert tables.latest_files(spark, str(tmp_path)).first()["n"] == 2
    with pytest.raises(FileNotFoundError):
        tables.latest_files(spark, str(tmp_path), without=".parquet")


def test_links_clean_and_failures(spark, df, tmp_path):
    links = spark.createDataFrame([("a",), ("a",), ("b",)], "link string")
    tables.write_links(links, str(tmp_path / "links"))
    assert sorted(r[0] for r in tables.read_links(spark, str(tmp_path / "links")).collect()) == ["a", "b"]
    tables.write_clean(df, str(tmp_path / "clean"))
    with pytest.raises(Exception, match="exists"):
        tables.write_clean(df, str(tmp_path / "clean"))
    assert tables.read_table(spark, str(tmp_path / "clean"), drop=["id"]).columns == ["t"]
    routed = spark.createDataFrame([(1, "u", "ok", None), (2, "v", "failed", "e")],
                                   "page_id int, url string, status string, error string")
    tables.write_failures(routed, str(tmp_path / "dead"))
    tables.write_failures(routed, str(tmp_path / "dead"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [(2, "v", "failed", "e")] * 2


def test_union(spark, df):
    got = tables.union_rows(df, df.select("t", F.lit(1).alias("n")), df.select("id"))
    assert got.columns == ["id", "t", "n"] and got.count() == 6


def test_settle_uses_the_session_folder(spark, df):
    folder = scratch_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder
    settled = settle(df)
    assert settled.inputFiles()[0].split("file://")[-1].startswith(folder)
    assert sorted(settled.collect()) == sorted(df.collect()) and settled.schema == df.schema
