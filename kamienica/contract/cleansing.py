"""Cleansing operators on stand-in columns, and the whole chain on listings derived from `part`."""

import uuid

from pyspark.sql import functions as F

from kamienica.contract.registry import query, table
from kamienica.functions import rules, text
from kamienica.operators import cleanse, dictionaries, sparse
from kamienica.plans import clean
from kamienica.session import scratch_dir

FLOORS_SQL = """CASE p_type WHEN 'PROMO' THEN 'parter/' || p_size WHEN 'SMALL' THEN '> 10/' || p_size
    WHEN 'STANDARD' THEN 'Poddasze' WHEN 'ECONOMY' THEN 'Zapytaj' WHEN 'MEDIUM' THEN p_size || '/60 '
    ELSE CAST(p_size AS VARCHAR) END"""
FLOOR_NUMBER_SQL = """CAST(CASE p_type WHEN 'PROMO' THEN 0 WHEN 'STANDARD' THEN 15 WHEN 'MEDIUM' THEN p_size
    WHEN 'LARGE' THEN p_size END AS INTEGER)"""
FLOORS_TOTAL_SQL = """CASE p_type WHEN 'PROMO' THEN CAST(p_size AS VARCHAR) WHEN 'SMALL' THEN CAST(p_size AS VARCHAR)
    WHEN 'MEDIUM' THEN '60 ' END"""


def _floor_text():
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    return (F.when(kind == "PROMO", F.concat(F.lit("parter/"), size))
             .when(kind == "SMALL", F.concat(F.lit("> 10/"), size)).when(kind == "STANDARD", "Poddasze")
             .when(kind == "ECONOMY", "Zapytaj").when(kind == "MEDIUM", F.concat(size, F.lit("/60 ")))
             .otherwise(size))


@query("surrogate_key", """
    SELECT c_custkey, md5(c_name || chr(1) || c_nationkey) AS id FROM customer""")
def surrogate_key(spark, folder):
    return cleanse.surrogate_key(table(spark, folder, "customer"), ["c_name", "c_nationkey"]).select("c_custkey", "id")


@query("fold_accents", f"""
    SELECT doc_id, nullif(translate(text, '{text.ACCENTS_FROM}', '{text.ACCENTS_TO}'), '') AS folded
    FROM documents""")
def fold_accents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.fold_accents(F.col("text")).alias("folded"))


@query("drop_null_target", "SELECT p_partkey, p_type FROM part WHERE nullif(p_type, 'PROMO') IS NOT NULL")
def drop_null_target(spark, folder):
    part = table(spark, folder, "part").withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return cleanse.drop_null_target(part, "p_type").select("p_partkey", "p_type")


@query("filter_contains", "SELECT o_orderkey, o_orderpriority FROM orders WHERE contains(o_orderpriority, 'NOT')")
def filter_contains(spark, folder):
    return cleanse.keep_containing(table(spark, folder, "orders"), "o_orderpriority", "NOT").select(
        "o_orderkey", "o_orderpriority")


@query("split_ratio", f"""
    SELECT p_partkey, CASE WHEN contains(f, '/') THEN split(f, '/')[1] ELSE f END AS own,
           CASE WHEN contains(f, '/') THEN split(f, '/')[2] END AS building
    FROM (SELECT p_partkey, {FLOORS_SQL} AS f FROM part)""")
def split_ratio(spark, folder):
    floor = _floor_text()
    return table(spark, folder, "part").select(
        "p_partkey", text.split_part(floor, "/", 0, whole_if_absent=True).alias("own"),
        text.floors_in_building(floor).alias("building"))


@query("floor_numbers", f"SELECT p_partkey, {FLOOR_NUMBER_SQL} AS floor FROM part")
def floor_numbers(spark, folder):
    return table(spark, folder, "part").select("p_partkey", text.floor_number(_floor_text()).alias("floor"))


@query("map_words", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '100' WHEN '2-HIGH' THEN '100'
        WHEN '5-LOW' THEN '-1' WHEN '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS priority FROM orders""")
def map_words(spark, folder):
    words = {"1-URGENT": "100", "2-HIGH": "100", "5-LOW": "-1", "4-NOT SPECIFIED": None}
    return table(spark, folder, "orders").select(
        "o_orderkey", text.map_words(F.col("o_orderpriority"), words).alias("priority"))


@query("parse_int", """
    SELECT p_partkey, CAST(CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_size * 1000 END AS INTEGER) AS n FROM part""")
def parse_int(spark, folder):
    raw = F.when(F.col("p_type") == "PROMO", F.concat(F.lit(">"), F.col("p_size").cast("string"))).otherwise(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" 000")))
    return table(spark, folder, "part").select("p_partkey", text.parse_int(raw).alias("n"))


def _area_text():
    return F.when(F.col("p_type") == "PROMO", "1 200,50 m²").otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(",25 m²")))


@query("parse_area", """
    SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_size + 0.25::DOUBLE END AS area,
           CASE WHEN p_type <> 'PROMO' THEN p_size + 0.25::DOUBLE ELSE 1200.5::DOUBLE END AS area_thousands FROM part""")
def parse_area(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", text.parse_number(_area_text(), rules.AREA_UNIT).alias("area"),
        text.parse_number(_area_text(), rules.AREA_UNIT, strip_thousands=True).alias("area_thousands"))


@query("sentinel_null", """
    SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
           nullif(c_name, 'Customer#000000007') AS c_name FROM customer""")
def sentinel_null(spark, folder):
    return cleanse.null_placeholders(table(spark, folder, "customer"), {
        "c_mktsegment": "BUILDING", "c_name": "Customer#000000007"}).select("c_custkey", "c_mktsegment", "c_name")


ROOMS_SQL = """CASE WHEN p_size > 40 THEN 'więcej niż 10' WHEN p_size < 5 THEN 'Zapytaj'
    ELSE p_size || ' ' END"""


def _rooms_text():
    return F.when(F.col("p_size") > 40, "więcej niż 10").when(F.col("p_size") < 5, "Zapytaj").otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(" ")))


@query("normalise_token", f"""
    SELECT p_partkey, replace(replace({ROOMS_SQL}, ' ', ''), 'więcejniż10', '11') AS rooms FROM part""")
def normalise_token(spark, folder):
    return table(spark, folder, "part").select("p_partkey", text.room_count(_rooms_text()).alias("rooms"))


@query("keyword_backfill", """
    SELECT doc_id, coalesce(nullif(lang, 'en'), CASE WHEN text LIKE '%License%' THEN 'licensed'
        WHEN text LIKE '%the%' THEN 'the' WHEN text LIKE '%en%' THEN 'en' END) AS lang FROM documents""")
def keyword_backfill(spark, folder):
    documents = cleanse.null_placeholders(table(spark, folder, "documents"), {"lang": "en"})
    return cleanse.backfill_from_text(documents, "text", {"lang": (
        (("License",), "licensed"), (("the",), "the"), (("en",), "en"))}).select("doc_id", "lang")


@query("keyword_backfill_any", """
    SELECT doc_id, coalesce(nullif(source, 'src1'),
        CASE WHEN text LIKE '%License%' OR text LIKE '%@%' THEN 'license or address' END) AS source FROM documents""")
def keyword_backfill_any(spark, folder):
    documents = cleanse.null_placeholders(table(spark, folder, "documents"), {"source": "src1"})
    return cleanse.backfill_from_text(documents, "text", {"source": (
        (("License", "@"), "license or address"),)}).select("doc_id", "source")


@query("strip_suffix", """
    SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_size || ' 200,50' END AS rent FROM part""")
def strip_suffix(spark, folder):
    raw = F.when(F.col("p_type") == "PROMO", rules.ASK).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(" 200,50 zł")))
    return table(spark, folder, "part").select(
        "p_partkey", text.strip_unit(F.nullif(raw, F.lit(rules.ASK)), rules.RENT_UNIT).alias("rent"))


@query("tokens_long", """
    SELECT p_partkey, 'p_name' AS source, unnest(split(p_name, ' ')) AS token FROM part
    UNION ALL SELECT p_partkey, 'p_type', unnest(split(nullif(p_type, 'PROMO'), ' ')) FROM part""")
def tokens_long(spark, folder):
    part = cleanse.null_placeholders(table(spark, folder, "part"), {"p_type": "PROMO"})
    return cleanse.tokens_long(part, ["p_name", "p_type"], ["p_partkey"], " ")


@query("vocabulary", """
    SELECT DISTINCT source, token FROM (
        SELECT 'p_name' AS source, unnest(split(p_name, ' ')) AS token FROM part
        UNION ALL SELECT 'p_type', p_type FROM part)
    WHERE NOT (source = 'p_name' AND token = 'red') AND NOT (source = 'p_type' AND token = 'PROMO')""")
def vocabulary(spark, folder):
    return cleanse.scan_vocabulary(table(spark, folder, "part"), {"p_name": "red", "p_type": "PROMO"}, " ")


_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring",
          "rod", "small", "widget"]
_DOUBLED = "CASE WHEN p_size > 25 THEN p_name || ' ' || p_name ELSE p_name END"


def _word_counts(source, suffix=""):
    return ", ".join(f"len(list_filter(split({source}, ' '), lambda x: x = '{w}')) AS {w}{suffix}" for w in _WORDS)


def _doubled(part):
    return part.withColumn("p_name", F.when(F.col("p_size") > 25, F.concat_ws(" ", "p_name", "p_name")).otherwise(
        F.col("p_name")))


@query("multi_hot", f"SELECT p_partkey, {_word_counts(_DOUBLED)} FROM part")
def multi_hot(spark, folder):
    part = _doubled(table(spark, folder, "part")).select("p_partkey", "p_name")
    words = cleanse.collect_vocabulary(cleanse.scan_vocabulary(part, {"p_name": None}, " "))
    return cleanse.multi_hot(part, ["p_name"], words, separator=" ")


@query("token_counts", f"""
    SELECT p_partkey, 'p_name' AS source, token, count(*) AS n
    FROM (SELECT p_partkey, unnest(split({_DOUBLED}, ' ')) AS token FROM part) GROUP BY ALL""")
def token_counts(spark, folder):
    return cleanse.token_counts(_doubled(table(spark, folder, "part")), "p_partkey", ["p_name"], " ")


_SPARSE = """
    WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents WHERE text IS NOT NULL),
         d AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS code FROM (SELECT DISTINCT token FROM t)),
         c AS (SELECT doc_id, token, code, count(*) AS n FROM t JOIN d USING (token) GROUP BY ALL)"""


def _document_words(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs, sparse.token_dictionary(cleanse.scan_vocabulary(docs, {"text": None}, " "))


@query("sparse_tokens", _SPARSE + """
    SELECT doc_id, count(*) AS kinds, sum(n)::BIGINT AS tokens, min(code) AS first_code, max(code) AS last_code,
           sum(code * n)::BIGINT AS checksum FROM c GROUP BY doc_id""")
def sparse_tokens(spark, folder):
    """Every word of the documents is a token: a vocabulary far beyond what could be columns."""
    docs, dictionary = _document_words(spark, folder)
    pairs = sparse.multi_hot_pairs(docs, "doc_id", ["text"], dictionary, separator=" ")
    return pairs.select("doc_id", F.size("tokens").cast("bigint").alias("kinds"),
                        F.expr("aggregate(tokens, 0L, (s, p) -> s + p.n)").alias("tokens"),
                        F.expr("tokens[0].code").alias("first_code"), F.expr("element_at(tokens, -1).code").alias("last_code"),
                        F.expr("aggregate(tokens, 0L, (s, p) -> s + p.code * p.n)").alias("checksum"))


@query("sparse_vectors", _SPARSE + """
    SELECT token, sum(n)::BIGINT AS total, count(*) AS docs FROM c GROUP BY token""")
def sparse_vectors(spark, folder):
    """The same as feature vectors, summed up by Spark ML: how often each token occurs, and in how many documents."""
    docs, dictionary = _document_words(spark, folder)
    vectors = sparse.multi_hot(docs, "doc_id", ["text"], dictionary, separator=" ")
    by_code = sparse.column_sums(vectors, "tokens")
    # both sides are as long as the dictionary; what Spark guesses of the sums is too small to go by
    return by_code.hint("merge").join(dictionary, "code").select("token", F.round("total").cast("bigint").alias("total"),
                                                                 F.round("docs").cast("bigint").alias("docs"))


@query("sparse_one_hot", """
    WITH p AS (SELECT 'c_mktsegment' AS source, c_mktsegment AS token, c_custkey FROM customer
               UNION ALL SELECT 'c_name', c_name, c_custkey FROM customer),
         d AS (SELECT source, token, row_number() OVER (ORDER BY source, token) - 1 AS code FROM (
               SELECT DISTINCT source, token FROM p QUALIFY token > min(token) OVER (PARTITION BY source)))
    SELECT c.c_custkey, count(d.code) AS entries, min(d.code) AS first_code, max(d.code) AS last_code
    FROM customer c JOIN p USING (c_custkey) LEFT JOIN d USING (source, token) GROUP BY c.c_custkey""")
def sparse_one_hot(spark, folder):
    """A category of its own for every customer."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_name")
    dictionary = sparse.category_dictionary(rows, ["c_mktsegment", "c_name"])
    pairs = sparse.one_hot_pairs(rows, "c_custkey", ["c_mktsegment", "c_name"], dictionary)
    return pairs.select("c_custkey", F.size("categories").cast("bigint").alias("entries"),
                        F.get("categories", 0)["code"].alias("first_code"),
                        F.when(F.size("categories") > 0, F.element_at("categories", -1)["code"]).alias("last_code"))


_EARLY = "TIMESTAMP '1996-01-01'"


@query("stable_codes", f"""
    WITH a AS (SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS code FROM orders
               WHERE o_orderdate < {_EARLY} GROUP BY o_custkey),
         b AS (SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) - 1 + (SELECT count(*) FROM a) AS code FROM orders
               WHERE o_custkey NOT IN (SELECT o_custkey FROM a) GROUP BY o_custkey)
    SELECT o_custkey, code, 1 AS version FROM a UNION ALL SELECT o_custkey, code, 2 FROM b""")
def stable_codes(spark, folder):
    """First-seen codes over two snapshots: early orders, then all."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    path = f"{scratch_dir(spark)}/codes-{uuid.uuid4().hex}"
    dictionaries.extend_dictionary(orders.where(f"o_orderdate < {_EARLY}"), path, 1, ["o_custkey"], "o_orderkey")
    return dictionaries.extend_dictionary(orders, path, 2, ["o_custkey"], "o_orderkey")


@query("stable_tokens", """
    WITH t AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part),
         a AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS code
               FROM (SELECT DISTINCT token FROM t WHERE p_partkey % 97 = 5)),
         b AS (SELECT token, row_number() OVER (ORDER BY token) - 1 + (SELECT count(*) FROM a) AS code
               FROM (SELECT DISTINCT token FROM t WHERE token NOT IN (SELECT token FROM a))),
         d AS (SELECT * FROM a UNION ALL SELECT * FROM b),
         c AS (SELECT p_partkey, code, count(*) AS n FROM t JOIN d USING (token) GROUP BY ALL)
    SELECT p_partkey, sum(code * n)::BIGINT AS checksum, max(code) AS last_code FROM c GROUP BY p_partkey""")
def stable_tokens(spark, folder):
    """Count vectors over a vocabulary that a second snapshot extends: codes of the first one stay."""
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    path = f"{scratch_dir(spark)}/codes-{uuid.uuid4().hex}"
    for version, rows in enumerate((part.where("p_partkey % 97 = 5"), part), 1):
        words = cleanse.scan_vocabulary(rows, {"p_name": None}, " ")
        dictionary = dictionaries.extend_dictionary(words, path, version, ["source", "token"])
    pairs = sparse.multi_hot_pairs(part, "p_partkey", ["p_name"], dictionary, separator=" ")
    return pairs.select("p_partkey", F.expr("aggregate(tokens, 0L, (s, p) -> s + p.code * p.n)").alias("checksum"),
                        F.expr("element_at(tokens, -1).code").alias("last_code"))


@query("multi_hot_join", f"""
    SELECT p_partkey, p_type, token, n FROM part JOIN (
        SELECT p_partkey, token, count(*) AS n
        FROM (SELECT p_partkey, unnest(split({_DOUBLED}, ' ')) AS token FROM part) GROUP BY ALL) USING (p_partkey)""")
def multi_hot_join(spark, folder):
    part = table(spark, folder, "part")
    counts = cleanse.token_counts(_doubled(part), "p_partkey", ["p_name"], " ").drop("source")
    return part.select("p_partkey", "p_type").join(counts, "p_partkey")


def raw_listings(spark, folder):
    """Listings with all 31 columns, derived from `part`."""
    size, kind, name = F.col("p_size").cast("string"), F.col("p_type"), F.col("p_name")
    text_of = lambda value: F.lit(value)
    words = F.replace(name, text_of(" "), text_of(", "))
    columns = {
        "ad_id": F.col("p_partkey").cast("string"), "powierzchnia": _area_text(),
        "forma_wlasnosci": F.when(kind == "LARGE", rules.ASK).otherwise(F.lower(kind)),
        "liczba_pokoi": _rooms_text(),
        "stan_wykonczenia": F.when(kind.isin("SMALL", "MEDIUM", "LARGE"), rules.ASK).otherwise("gotowe"),
        "pietro": _floor_text(),
        "balkon___ogrod___taras": F.when(kind == "PROMO", rules.ASK).otherwise(words),
        "czynsz": F.when(kind == "PROMO", rules.ASK).otherwise(F.concat(size, text_of(" 200,50 zł"))),
        "miejsce_parkingowe": F.when(kind == "SMALL", "garaż").otherwise(rules.ASK),
        "ogrzewanie": F.when(kind == "SMALL", "inne").otherwise(rules.ASK),
        "rynek": F.lower(kind), "dostepne_od": F.when(kind == "PROMO", rules.NO_INFORMATION).otherwise("2024-05-01"),
        "rok_budowy": F.when(kind == "PROMO", rules.NO_INFORMATION).otherwise(F.concat(text_of("19"), size)),
        "rodzaj_zabudowy": text_of(rules.NO_INFORMATION), "okna": text_of("plastikowe"), "winda": text_of("tak"),
        "media": F.nullif(F.when(F.col("p_size") > 45, "").otherwise("internet, woda, internet"), text_of("")),
        "zabezpieczenia": text_of("drzwi / okna"), "wyposazenie": text_of(rules.NO_INFORMATION),
        "informacje_dodatkowe": F.when(F.col("p_size") > 25, "Winda").otherwise(rules.NO_INFORMATION),
        "material_budynku": text_of(rules.NO_INFORMATION), "adres": name,
        "opis": F.concat(name, F.when(F.startswith(name, text_of("hot")), " do remontu, do zamieszkania")
                         .when(F.startswith(name, text_of("cold")), " do zamieszkania, parking, gazowe miejskie")
                         .otherwise(" do wykonczenia")),
        "ad_photo": text_of("x"), "price_currency": F.when(kind == "ECONOMY", "EUR").otherwise("PLN"),
        "ad_price": F.nullif(F.col("p_retailprice"), F.lit(900.0)), "city_id": size,
        "poster_type": text_of("private"), "region_id": size, "subregion_id": size,
        "latitude": F.col("p_size") / 2, "longitude": F.col("p_size") / 4,
    }
    return table(spark, folder, "part").select(*[c.alias(n) for n, c in columns.items()])


# ' / ' folds to '___'; the listing column `winda` takes the plain name, so the token gets its source in front
_BALCONY = [w for w in _WORDS]
CLEAN_SQL = f"""
    SELECT CAST(p_partkey AS VARCHAR) AS ad_id,
        CAST(CASE WHEN p_type <> 'PROMO' THEN p_size + 0.25 END AS FLOAT) AS powierzchnia,
        CASE WHEN p_type <> 'LARGE' THEN lower(p_type) END AS forma_wlasnosci,
        CASE WHEN p_size > 40 THEN '11' WHEN p_size >= 5 THEN CAST(p_size AS VARCHAR) END AS liczba_pokoi,
        CASE WHEN p_type NOT IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'gotowe' WHEN p_name LIKE 'hot%' THEN 'do remontu'
             WHEN p_name LIKE 'cold%' THEN 'do zamieszkania' ELSE 'do wykończenia' END AS stan_wykonczenia,
        CASE WHEN p_type <> 'PROMO' THEN p_size || ' 200,50' END AS czynsz,
        CASE WHEN p_type = 'SMALL' THEN 'garaż' WHEN p_name LIKE 'cold%' THEN 'garaż/miejsce parkingowe' END
            AS miejsce_parkingowe,
        CASE WHEN p_type = 'SMALL' THEN 'inne' WHEN p_name LIKE 'cold%' THEN 'miejskie' END AS ogrzewanie,
        lower(p_type) AS rynek, CASE WHEN p_type <> 'PROMO' THEN '2024-05-01' END AS dostepne_od,
        CASE WHEN p_type <> 'PROMO' THEN '19' || p_size END AS rok_budowy, CAST(NULL AS VARCHAR) AS rodzaj_zabudowy,
        'plastikowe' AS okna, 'tak' AS winda, CAST(NULL AS VARCHAR) AS material_budynku, p_name AS adres,
        p_name || CASE WHEN p_name LIKE 'hot%' THEN ' do remontu, do zamieszkania'
            WHEN p_name LIKE 'cold%' THEN ' do zamieszkania, parking, gazowe miejskie'
            ELSE ' do wykonczenia' END AS opis,
        'x' AS ad_photo, 'PLN' AS price_currency, p_retailprice AS ad_price, CAST(p_size AS VARCHAR) AS city_id,
        'private' AS poster_type, CAST(p_size AS VARCHAR) AS region_id, CAST(p_size AS VARCHAR) AS subregion_id,
        p_size / 2 AS latitude, p_size / 4 AS longitude, {FLOOR_NUMBER_SQL} AS ktore_pietro,
        {FLOORS_TOTAL_SQL} AS ile_pieter,
        {", ".join(f"CASE WHEN p_type = 'PROMO' THEN 0 ELSE len(list_filter(split(p_name, ' '), lambda x: x = '{w}')) END AS {w}" for w in _BALCONY)},
        CAST(2 AS BIGINT) AS internet, CAST(1 AS BIGINT) AS woda, CAST(1 AS BIGINT) AS drzwi___okna,
        CAST(p_size > 25 AS BIGINT) AS informacje_dodatkowe_Winda
    FROM part WHERE p_type <> 'ECONOMY' AND p_retailprice <> 900.0 AND p_size <= 45"""


@query("clean_listings", CLEAN_SQL)
def clean_listings(spark, folder):
    raw = raw_listings(spark, folder)
    vocabulary = cleanse.collect_vocabulary(clean.listing_vocabulary(raw))
    return clean.clean_listings(raw, vocabulary)


@query("keyword_rules_many", """
    SELECT c_custkey, 'v' || min(r) AS value FROM customer
    JOIN (SELECT unnest(range(10000)) AS r) ON c_name LIKE '%' || lpad(((r * 7919 + 13) % 10000)::VARCHAR, 4, '0') || '%'
    GROUP BY c_custkey""")
def keyword_rules_many(spark, folder):
    """Ten thousand rules in one pass; the first that matches counts."""
    rules = [((f"{(r * 7919 + 13) % 10000:04d}",), f"v{r}") for r in range(10_000)]
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", F.lit(None).cast("string").alias("value"))
    return cleanse.backfill_from_text(rows, "c_name", {"value": rules}).select("c_custkey", "value")
