"""Pages to adverts. The test pages carry no advert markup, so advert pages are derived from `part` and
`events` in Spark; the page-level operators also run over the given pages."""

from pyspark.sql import functions as F

from kamienica.contract.registry import query, table
from kamienica.operators import extract


@query("page_links", """
    SELECT i AS page_no, 'https://listings.example/page/' || i AS link
    FROM (SELECT unnest(range(1, max(page_id) + 2)) AS i FROM pages)""")
def page_links(spark, folder):
    last = table(spark, folder, "pages").agg(F.max("page_id")).first()[0] + 1
    return extract.page_links(spark, last, "https://listings.example/page/")


@query("last_list_item", r"""
    SELECT page_id, trim(regexp_replace(
        regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1)[-1], '<[^>]*>', '', 'g')) AS item FROM pages""")
def last_list_item(spark, folder):
    return table(spark, folder, "pages").select("page_id", extract.last_list_item(F.col("html")).alias("item"))


@query("last_page_number", "SELECT page_id, CAST(page_id + 7 AS INTEGER) AS last_page FROM pages")
def last_page_number(spark, folder):
    pager = F.concat("html", F.lit('<ul><li class="pager">1</li><li class="pager x"> '),
                     (F.col("page_id") + 9).cast("string"), F.lit('</li><li class="pager"> '),
                     (F.col("page_id") + 8).cast("string"), F.lit('</li><li id="z" class="last pager now"> '),
                     (F.col("page_id") + 7).cast("string"), F.lit('</li><li class="pagers"> 5</li></ul>'))
    return table(spark, folder, "pages").select(
        "page_id", extract.last_page_number(pager, "pager").alias("last_page"))


@query("zip_pairs", """
    SELECT p_partkey, CAST(pos AS INTEGER) AS pos, a[pos] AS label, b[pos] AS value FROM (
        SELECT p_partkey, a, b, unnest(range(1, least(len(a), len(b)) + 1)) AS pos FROM (
            SELECT p_partkey, split(p_name || ' x', ' ') AS a,
                   split(CASE WHEN p_size > 25 THEN p_type ELSE p_type || ' ' || p_brand || ' y z' END, ' ') AS b
            FROM part))""")
def zip_pairs(spark, folder):
    short, full = F.col("p_type"), F.concat_ws(" ", "p_type", "p_brand", F.lit("y z"))
    return extract.zip_pairs(
        table(spark, folder, "part"), "p_partkey", F.split(F.concat("p_name", F.lit(" x")), " "),
        F.split(F.when(F.col("p_size") > 25, short).otherwise(full), " "))


_LAST = """SELECT user_id, event_type, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1"""


@query("last_wins", _LAST)
def last_wins(spark, folder):
    return extract.last_wins(table(spark, folder, "events"), ["user_id", "event_type"], "value", "event_id")


@query("drop_keys", f"SELECT * FROM ({_LAST}) WHERE event_type <> 'error'")
def drop_keys(spark, folder):
    return extract.drop_keys(last_wins(spark, folder), "event_type", ["error"])


@query("keep_keys", "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase')")
def keep_keys(spark, folder):
    return extract.keep_keys(table(spark, folder, "events"), "event_type", ["click", "purchase"]).select(
        "event_id", "event_type", "value")


@query("merge_right_wins", """
    WITH l AS (SELECT user_id, event_type, max(value) AS value FROM events GROUP BY ALL),
         r AS (SELECT user_id, event_type, min(value) AS value FROM events WHERE value > 50 GROUP BY ALL)
    SELECT user_id, event_type, coalesce(r.value, l.value) AS value
    FROM l FULL JOIN r USING (user_id, event_type)""")
def merge_right_wins(spark, folder):
    events, by = table(spark, folder, "events"), ["user_id", "event_type"]
    left = events.groupBy(*by).agg(F.max("value").alias("value"))
    right = events.where(F.col("value") > 50).groupBy(*by).agg(F.min("value").alias("value"))
    return extract.merge_right_wins(left, right, by, "value")


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("pairs_to_wide", f"""
    SELECT user_id, {", ".join(f"max(value) FILTER (event_type = '{t}') AS {t}" for t in _EVENT_TYPES)}
    FROM ({_LAST}) GROUP BY user_id""")
def pairs_to_wide(spark, folder):
    return extract.pairs_to_wide(last_wins(spark, folder), "user_id", "event_type", "value",
                                 _EVENT_TYPES)


@query("coalesce_text", r"""
    SELECT page_id, coalesce(nullif(regexp_extract(html, '<p>([^<]*)</p>', 1), ''),
                             regexp_extract(html, '<h1>([^<]*)</h1>', 1)) AS text FROM pages""")
def coalesce_text(spark, folder):
    def first(tag):
        return F.regexp_extract("html", rf"<{tag}>([^<]*)</{tag}>", 1)
    return table(spark, folder, "pages").select(
        "page_id", F.coalesce(F.nullif(first("p"), F.lit("")), first("h1")).alias("text"))


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, folder):
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("route_valid", """
    SELECT doc_id, CASE WHEN contains(text, '@') OR n_chars < 200 THEN 'failed' ELSE 'ok' END AS status
    FROM documents""")
def route_valid(spark, folder):
    valid = ~F.contains("text", F.lit("@")) & (F.col("n_chars") >= 200)
    return extract.route(table(spark, folder, "documents"), valid).select("doc_id", "status")


def _cell(label, value):
    return F.concat(F.lit(f'<tr><td data-cy="table-label-content">{label}</td>'
                          '<td data-testid="table-value-x"><b>'), value, F.lit("</b></td></tr>"))


def advert_pages(spark, folder):
    """One advert page per part: cells with a repeated label, remote-viewing cells, a description in one of
    two places, embedded JSON with a repeated leaf; pages of one size have no price."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    remote = ('<tr aria-label="Obsługa zdalna"><td data-cy="table-label-content">Obsługa zdalna</td>'
              '<td data-cy="missing-value">brak</td></tr>')
    html = F.concat(
        F.lit('<html><body><p class="x">no</p><a aria-label="Adres" href="#">ul. '), "p_name", F.lit("</a>"),
        F.when(F.col("p_size") != 13, F.concat(F.lit('<strong aria-label="Cena">'), size,
                                               F.lit(" 000 zł</strong>"))).otherwise(""),
        F.lit("<table>"), _cell("Rynek", F.lit("old")), F.lit(remote), _cell("Marka", F.col("p_brand")),
        F.lit('<tr><td data-cy="table-label-content">Okna</td><td data-cy="missing-value">brak informacji</td></tr>'),
        _cell("Rynek", F.col("p_type")), F.lit('<tr><td data-cy="table-label-x">Extra</td></tr></table>'),
        F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.concat(F.lit("<p>Opis &amp; "), "p_name", F.lit("</p>"))),
        F.lit('<div data-cy="adPageAdDescription"><i>div</i> '), "p_name", F.lit("</div>"),
        F.lit('<script id="__NEXT_DATA__" type="application/json">{"props": {"ad_id": 0, "page": {"ad_price": '), size,
        F.lit(', "other": 1, "security": ["a", "b"], "street": null}}, "ad_id": '), key,
        F.lit(', "poster_type": "'), "p_type", F.lit('"}</script></body></html>'))
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return extract.spread_pages(parts).select(
        F.col("p_partkey").alias("page_id"), F.concat(F.lit("/ad/"), key).alias("url"), html.alias("html"))


ADVERT_COLUMNS = ["Adres", "Cena", "Marka", "Okna", "Opis", "Rynek", "ad_id", "ad_price", "poster_type",
                  "security", "street", "url"]


@query("adverts_wide", """
    SELECT p_partkey AS page_id, 'ul. ' || p_name AS Adres, p_size || ' 000 zł' AS Cena, p_brand AS Marka,
           'brak informacji' AS Okna,
           CASE WHEN p_type = 'PROMO' THEN 'div ' || p_name ELSE 'Opis & ' || p_name END AS Opis,
           p_type AS Rynek, CAST(p_partkey AS VARCHAR) AS ad_id, CAST(p_size AS VARCHAR) AS ad_price,
           p_type AS poster_type, '["a", "b"]' AS security, CAST(NULL AS VARCHAR) AS street,
           'https://listings.example/ad/' || p_partkey AS url
    FROM part WHERE p_size <> 13""")
def adverts_wide(spark, folder):
    routed = extract.extract_adverts(advert_pages(spark, folder), base="https://listings.example")
    return extract.wide_adverts(routed, ADVERT_COLUMNS)


@query("adverts_failed", """
    SELECT p_partkey AS page_id, 'https://listings.example/ad/' || p_partkey AS url, 'failed' AS status,
           'no price' AS error FROM part WHERE p_size = 13""")
def adverts_failed(spark, folder):
    routed = extract.extract_adverts(advert_pages(spark, folder), base="https://listings.example")
    return extract.failed_adverts(routed)


@query("pages_routed", "SELECT page_id, url, 'failed' AS status, 'no address' AS error FROM pages")
def pages_routed(spark, folder):
    return extract.extract_adverts(table(spark, folder, "pages")).select("page_id", "url", "status", "error")
