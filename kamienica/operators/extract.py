"""From a table of pages to links and to one record per advert.

Links need a pattern only and stay in the JVM. Adverts need a real HTML parser: one `mapInPandas` pass turns a
page into small arrays, everything after it is row-local Catalyst work, so extraction never shuffles.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kamienica.functions import rules
from kamienica.functions.html import advert_row
from kamienica.operators.cleanse import MAX_COLUMNS, quoted

PAGES_PER_TASK = 5000  # about a second of parsing
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_HREF = r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
_PARTS = ("page_id bigint, url string, labels array<string>, values array<string>, address string, "
          "price string, description string, fields array<struct<key:string,value:string>>, error string")


def page_links(spark: SparkSession, last: int, base: str) -> DataFrame:
    """The addresses of listing pages 1..last."""
    return spark.range(1, last + 1).select(
        F.col("id").alias("page_no"), F.concat(F.lit(base), F.col("id").cast("string")).alias("link"))


def last_list_item(html: Column, css_class: str | None = None) -> Column:
    """Text of the last `<li>`, optionally of those that have the class among their classes; null if there is none."""
    word = rf'(?:[^"]*\s)?\Q{css_class}\E(?:\s[^"]*)?'
    attribute = rf'[^>]*\bclass="{word}"' if css_class else ""
    items = F.regexp_extract_all(html, F.lit(rf"(?is)<li\b{attribute}[^>]*>(.*?)</li>"), F.lit(1))
    return F.trim(F.regexp_replace(F.try_element_at(items, F.lit(-1)), r"<[^>]*>", ""))


def last_page_number(html: Column, css_class: str | None = None) -> Column:
    return last_list_item(html, css_class).try_cast("int")


def hrefs(html: Column) -> Column:
    """Addresses of all anchors outside comments, scripts and styles; anchors without one are skipped."""
    found = F.regexp_extract_all(F.regexp_replace(html, _HIDDEN, ""), F.lit(_HREF), F.lit(1))
    return F.transform(found, lambda h: F.replace(h, F.lit("&amp;"), F.lit("&")))


def extract_links(pages: DataFrame, include: str = "", exclude: str | None = None,
                  base: str = "") -> DataFrame:
    """One row per anchor that contains `include` and not `exclude`; `url` is the completed address."""
    links = pages.select("page_id", F.explode(hrefs(F.col("html"))).alias("link"))
    if include:
        links = links.where(F.contains("link", F.lit(include)))
    if exclude is not None:
        links = links.where(~F.contains("link", F.lit(exclude)))
    return links.withColumn("url", F.concat(F.lit(base), F.col("link")))


def spread_pages(rows: DataFrame, per_task: int = PAGES_PER_TASK) -> DataFrame:
    """The same rows, dealt evenly over tasks of about `per_task`.

    For pages made from a narrow table: its file is one split however many pages it gives. A table that holds the pages
    themselves comes in splits by size and needs no shuffle.
    """
    return rows.repartition(max(1, math.ceil(rows.count() / per_task)))


def advert_parts(pages: DataFrame, keep_keys: Iterable[str] = rules.JSON_KEYS) -> DataFrame:
    """One row per page with its labels, values, single texts, JSON fields, or the error."""
    kept = frozenset(keep_keys)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [advert_row(html, kept) for html in batch["html"]]
            yield pd.concat([batch[["page_id", "url"]].reset_index(drop=True), pd.DataFrame(rows, columns=[
                "labels", "values", "address", "price", "description", "fields", "error"])], axis=1)

    return pages.select("page_id", "url", "html").mapInPandas(parse, _PARTS)


def zip_arrays(keys: Column, values: Column) -> Column:
    """Array of (key, value) by position, as long as the shorter array."""
    n = F.least(F.size(keys), F.size(values))
    return F.zip_with(F.slice(keys, 1, n), F.slice(values, 1, n),
                      lambda k, v: F.struct(k.alias("key"), v.alias("value")))


def last_wins_map(entries: Column) -> Column:
    """Map of an entry array; of a repeated key the last value stays."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(
        keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))


def extract_adverts(pages: DataFrame, keep_keys: Iterable[str] = rules.JSON_KEYS,
                    base: str = "") -> DataFrame:
    """Every page once: `status` ok with its fields in the map `data`, or failed with the `error`.

    Later sources win: table cells, then address, price and description, then the embedded JSON.
    """
    parts = advert_parts(pages, keep_keys).withColumn("url", F.concat(F.lit(base), F.col("url")))

    def single(key: str, column: str) -> Column:
        return F.struct(F.lit(key).alias("key"), F.col(column).alias("value"))

    cells = F.filter(zip_arrays(F.col("labels"), F.col("values")),
                     lambda e: e["key"] != rules.REMOTE_LABEL)
    entries = F.concat(
        cells,
        F.array(single("url", "url"), single(rules.ADDRESS_LABEL, "address"),
                single(rules.PRICE_LABEL, "price"), single(rules.DESCRIPTION_LABEL, "description")),
        F.col("fields"))
    ok = F.col("error").isNull()
    return parts.withColumn("_entries", entries).select(
        "page_id", "url", F.when(ok, "ok").otherwise("failed").alias("status"), "error",
        F.when(ok, last_wins_map(F.col("_entries"))).alias("data"))


def advert_keys(routed: DataFrame, limit: int = MAX_COLUMNS) -> list[str]:
    """All field names that occur, sorted; refuses more than `limit`."""
    keys = routed.where(F.col("status") == "ok").select(F.explode(F.map_keys("data")).alias("key"))
    found = [r["key"] for r in keys.distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} distinct field names; keep the map column instead")
    return sorted(found)


def wide_adverts(routed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Usable adverts with one text column per key; keys an advert lacks are null."""
    return routed.where(F.col("status") == "ok").select(
        "page_id", *[F.try_element_at("data", F.lit(k)).alias(k) for k in keys])


def failed_adverts(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("status") == "failed").select("page_id", "url", "status", "error")


# --- the same steps for tables that are already long ---------------------------------------------------

def zip_pairs(df: DataFrame, key: str, labels: Column, values: Column) -> DataFrame:
    """Long (key, pos, label, value) of two arrays zipped by position, positions from 1."""
    return df.select(quoted(key), F.posexplode(zip_arrays(labels, values)).alias("_pos", "_e")).select(
        quoted(key), (F.col("_pos") + 1).alias("pos"), F.col("_e.key").alias("label"),
        F.col("_e.value").alias("value"))


def last_wins(df: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """One row per `by`: the value with the highest `order`. Combines before it shuffles."""
    return df.groupBy(*by).agg(F.max_by(value, order).alias(value))


def keep_keys(df: DataFrame, column: str, keys: Iterable[str]) -> DataFrame:
    return df.where(quoted(column).isin(*keys))


def drop_keys(df: DataFrame, column: str, keys: Iterable[str]) -> DataFrame:
    return df.where(~quoted(column).isin(*keys))


def merge_right_wins(left: DataFrame, right: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Union of two long tables; where both have a key, the right value stays."""
    ranked = left.select(*by, value, F.lit(0).alias("_source")).unionByName(
        right.select(*by, value, F.lit(1).alias("_source")))
    return last_wins(ranked, by, value, "_source")


def pairs_to_wide(df: DataFrame, key: str, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long to wide for known names: one shuffle, no extra job to find them."""
    return df.groupBy(key).pivot(name, list(names)).agg(F.first(value))


def route(df: DataFrame, valid: Column) -> DataFrame:
    """Tag rows `ok` or `failed`; an undecidable predicate counts as failed."""
    return df.withColumn("status", F.when(valid, "ok").otherwise("failed"))
