"""Snapshots, links, round trips, unions."""

from pyspark.sql import functions as F

from kamienica.contract.registry import query, table
from kamienica.operators import extract
from kamienica.session import scratch_dir
from kamienica.sources import tables

import uuid


def _new_folder(spark) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/kamienica-{uuid.uuid4().hex}"


@query("latest_snapshot", """
    SELECT event_id, event_type, value FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_snapshot(spark, folder):
    events = table(spark, folder, "events")
    return tables.latest_rows(events, F.to_date("ts")).select("event_id", "event_type", "value")


@query("latest_partition", """
    SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_partition(spark, folder):
    path = _new_folder(spark)
    (table(spark, folder, "events").select("event_id", "event_type", F.to_date("ts").alias("snapshot"))
        .write.partitionBy("snapshot").parquet(path))
    newest = tables.latest_partition(spark, path)
    return newest.withColumn("snapshot", F.col("snapshot").cast("string"))


@query("latest_files", """
    SELECT event_id, event_type, value FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_files(spark, folder):
    """Two snapshots of several parts each, the newer one written last."""
    path = _new_folder(spark)
    events = table(spark, folder, "events")
    newest = tables.latest_rows(events, F.to_date("ts")).select("event_id", "event_type", "value")
    events.select("event_id", "event_type", "value").repartition(3).write.parquet(f"{path}/first")
    newest.repartition(4).write.parquet(f"{path}/second")
    return tables.latest_files(spark, path)


@query("snapshot_round_trip", """
    SELECT p_partkey, p_name, 'b' AS snapshot FROM part WHERE p_size > 20""")
def snapshot_round_trip(spark, folder):
    """A snapshot written, another added and written once more; only the repeated one is replaced."""
    path = _new_folder(spark)
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    for rows, name in ((parts, "a"), (parts, "b"), (parts.where("p_size > 20"), "b")):
        tables.write_snapshot(rows.drop("p_size"), path, name)
    return tables.latest_partition(spark, path)


@query("clean_round_trip", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def clean_round_trip(spark, folder):
    path = _new_folder(spark)
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal").where("c_acctbal > 0")
    tables.write_clean(rows, path)
    return tables.read_table(spark, path, rows.schema)


@query("dead_letters", """
    SELECT page_id, url, 'failed' AS status, 'no address' AS error FROM pages""")
def dead_letters(spark, folder):
    path = _new_folder(spark)
    tables.write_failures(extract.extract_adverts(table(spark, folder, "pages")), path)
    return tables.read_table(spark, path)


@query("scan_drop_column", "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def scan_drop_column(spark, folder):
    return tables.read_table(spark, f"{folder}/part.parquet", drop=["p_retailprice"])


@query("json_round_trip", "SELECT event_id, event_type, props, CAST(NULL AS VARCHAR) AS _corrupt_record FROM events")
def json_round_trip(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "event_type", "props")
    path = _new_folder(spark)
    tables.append_json(rows, path)
    return tables.read_json(spark, path, rows.schema)


_LINKS_SQL = r"""
    SELECT page_id, replace(link, '&amp;', '&') AS link FROM (
        SELECT page_id, unnest(regexp_extract_all(
            regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
            '(?is)<a\s[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)) AS link FROM pages)"""


@query("links_extract", _LINKS_SQL)
def links_extract(spark, folder):
    return extract.extract_links(table(spark, folder, "pages")).select("page_id", "link")


@query("links_filter", f"""
    SELECT page_id, link, 'https://listings.example' || link AS url FROM ({_LINKS_SQL})
    WHERE contains(link, 'e') AND NOT contains(link, ',')""")
def links_filter(spark, folder):
    return extract.extract_links(table(spark, folder, "pages"), "e", ",", "https://listings.example")


@query("links_distinct", f"SELECT DISTINCT link FROM ({_LINKS_SQL})")
def links_distinct(spark, folder):
    path = _new_folder(spark)
    tables.write_links(extract.extract_links(table(spark, folder, "pages")), path)
    return tables.read_links(spark, path)


@query("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return tables.union_rows(customers, suppliers)
