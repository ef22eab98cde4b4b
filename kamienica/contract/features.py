"""Encoders, outliers, correlation, neighbours, scaling, split and PCA."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kamienica.contract.profiling import FIRST_SEEN_SQL
from kamienica.contract.registry import query, table
from kamienica.operators import encode, gram, neighbours, outliers, scale, sketch_pca
from kamienica.plans.features import FeatureConfig, build_features

_ORDINAL = """(SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
               FROM (SELECT DISTINCT {column} AS value FROM {table} WHERE {column} IS NOT NULL))"""


@query("ordinal_encode", f"""
    SELECT p_partkey, code AS p_brand FROM (SELECT p_partkey, nullif(p_brand, 'Brand#3') AS p_brand FROM part)
    LEFT JOIN {_ORDINAL.format(column="nullif(p_brand, 'Brand#3')", table="part")} ON p_brand = value""")
def ordinal_encode(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", F.nullif("p_brand", F.lit("Brand#3")).alias("p_brand"))
    return encode.encode(part, "p_brand", encode.ordinal_dictionary(part, "p_brand"))


@query("ordinal_encode_wide", f"""
    SELECT doc_id, code FROM documents JOIN {_ORDINAL.format(column="text", table="documents")} ON text = value""")
def ordinal_encode_wide(spark, folder):
    """A dictionary as wide as the table, numbered range by range."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    dictionary = encode.ordinal_dictionary(documents, "text", rows_per_range=200)
    return encode.encode(documents, "text", dictionary, "code").select("doc_id", "code")


def _segments(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))


@query("first_seen_encode", f"""
    SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, code
    FROM customer JOIN {FIRST_SEEN_SQL} ON coalesce(nullif(c_mktsegment, 'BUILDING'), 'to_fill') = value""")
def first_seen_encode(spark, folder):
    rows = _segments(spark, folder)
    dictionary = encode.first_seen_dictionary(rows, "segment", "c_custkey", "to_fill")
    return encode.encode(rows, "segment", dictionary, "code", fill="to_fill")


@query("decode_codes", """
    SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'to_fill') AS segment FROM customer""")
def decode_codes(spark, folder):
    rows = _segments(spark, folder)
    dictionary = encode.first_seen_dictionary(rows, "segment", "c_custkey", "to_fill")
    return encode.decode(encode.encode(rows, "segment", dictionary, fill="to_fill"), "segment", dictionary)


@query("one_hot", """
    SELECT c_custkey, (c_mktsegment = 'BUILDING')::INT AS "c_mktsegment_BUILDING",
        (c_mktsegment = 'FURNITURE')::INT AS "c_mktsegment_FURNITURE",
        (c_mktsegment = 'HOUSEHOLD')::INT AS "c_mktsegment_HOUSEHOLD" FROM customer""")
def one_hot(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("c_mktsegment"))
    return encode.one_hot(rows, encode.categories(rows, ["c_mktsegment"]))


@query("merge_on_key", """
    SELECT c_custkey, c_acctbal, code AS c_mktsegment FROM customer
    JOIN (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
          FROM (SELECT DISTINCT c_mktsegment AS value FROM customer)) ON c_mktsegment = value""")
def merge_on_key(spark, folder):
    customers = table(spark, folder, "customer")
    coded = encode.multi_column_codes(customers.select("c_custkey", "c_mktsegment"), ["c_mktsegment"])
    return encode.merge_on_key(customers.select("c_custkey", "c_acctbal"), coded, "c_custkey")


@query("outliers_iqr", """
    WITH s AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT event_id, value FROM events, s
    WHERE value > q1 - 1.5 * (q3 - q1) AND value < q3 + 1.5 * (q3 - q1)""")
def outliers_iqr(spark, folder):
    return outliers.inside_iqr(table(spark, folder, "events").select("event_id", "value"), "value")


@query("outliers_zscore", """
    WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
    SELECT event_id, value FROM events, s WHERE abs((value - m) / d) < 3""")
def outliers_zscore(spark, folder):
    return outliers.inside_zscore(table(spark, folder, "events").select("event_id", "value"), "value")


@query("outliers_two_rounds", """
    WITH a AS (SELECT event_id, user_id, value FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
               WHERE abs((value - m) / d) < 3),
         b AS (SELECT event_id, user_id, value FROM a, (SELECT avg(user_id) AS m, stddev_pop(user_id) AS d FROM a)
               WHERE abs((user_id - m) / d) < 3),
         c AS (SELECT event_id, user_id, value FROM b, (SELECT avg(value) AS m, stddev_pop(value) AS d FROM b)
               WHERE abs((value - m) / d) < 3)
    SELECT event_id, user_id, value FROM c, (SELECT avg(user_id) AS m, stddev_pop(user_id) AS d FROM c)
    WHERE abs((user_id - m) / d) < 3""")
def outliers_two_rounds(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "value")
    return outliers.drop_outliers(rows, ["value", "user_id"], 2)


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:]))
def corr_pairs(spark, folder):
    found = outliers.correlations(table(spark, folder, "lineitem"), _CORR)
    return spark.createDataFrame([(a, b, round(r, 6)) for (a, b), r in found.items()], "a string, b string, r double")


@query("corr_pairs_with_nulls", """
    SELECT 'l_quantity' AS a, 'price' AS b, round(corr(l_quantity, p), 6) AS r FROM (
        SELECT l_quantity, CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END AS p FROM lineitem)
    UNION ALL SELECT 'l_quantity', 'tax', round(corr(l_quantity, nullif(l_tax, 0)), 6) FROM lineitem
    UNION ALL SELECT 'price', 'tax', round(corr(p, t), 6) FROM (
        SELECT CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END AS p, nullif(l_tax, 0) AS t FROM lineitem)""")
def corr_pairs_with_nulls(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_quantity", F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice")).alias("price"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    found = outliers.correlations(rows, rows.columns)
    return spark.createDataFrame([(a, b, round(r, 6)) for (a, b), r in found.items()], "a string, b string, r double")


@query("drop_correlated", "SELECT o_orderkey, o_totalprice, o_custkey::DOUBLE AS customer FROM orders")
def drop_correlated(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_totalprice") * -2 + 1).alias("mirrored"),
        F.col("o_custkey").cast("double").alias("customer"),
        (F.col("o_orderkey") + F.col("o_totalprice") / 1e9).alias("shifted"))
    return outliers.drop_correlated(rows, 0.75)


def _knn_sql(source, key, target, missing, on):
    """Brute force: every gap against every known row."""
    distance = " + ".join(f"(q.{c}::DOUBLE - d.{c}::DOUBLE) * (q.{c}::DOUBLE - d.{c}::DOUBLE)" for c in on)
    return f"""
    WITH d AS (SELECT * FROM {source} WHERE NOT ({missing})), q AS (SELECT * FROM {source} WHERE {missing}),
         n AS (SELECT q.{key} AS k, d.{target}::DOUBLE AS v, sqrt({distance}) AS dist FROM q, d
               QUALIFY row_number() OVER (PARTITION BY q.{key} ORDER BY {distance}, d.{key}) <= 5)
    SELECT {key}, round({target}::DOUBLE, 4) AS {target} FROM d
    UNION ALL
    SELECT k, round(coalesce(avg(v) FILTER (dist = 0),
                       sum(CASE WHEN dist > 0 THEN v / dist END) / sum(CASE WHEN dist > 0 THEN 1 / dist END)), 4)
    FROM n GROUP BY k"""


def _with_gaps(rows, target, missing):
    return rows.withColumn(target, F.when(~missing, F.col(target)))


@query("knn_impute", _knn_sql("supplier", "s_suppkey", "s_acctbal", "s_nationkey < 5", ["s_nationkey", "s_suppkey"]))
def knn_impute(spark, folder):
    rows = _with_gaps(table(spark, folder, "supplier"), "s_acctbal", F.col("s_nationkey") < 5)
    filled = neighbours.knn_impute(rows.withColumn("near", F.col("s_suppkey")), "s_suppkey", "s_acctbal",
                                   ["s_nationkey", "near"])
    return filled.select("s_suppkey", F.round("s_acctbal", 4).alias("s_acctbal"))


@query("knn_impute_customers", _knn_sql("customer", "c_custkey", "c_nationkey", "c_mktsegment = 'BUILDING'",
                                        ["c_acctbal"]))
def knn_impute_customers(spark, folder):
    """Gaps in the country, filled by balance, through cells of few rows."""
    rows = _with_gaps(table(spark, folder, "customer"), "c_nationkey", F.col("c_mktsegment") == "BUILDING")
    filled = neighbours.knn_impute(rows, "c_custkey", "c_nationkey", ["c_acctbal"], cell_rows=100)
    return filled.select("c_custkey", F.round("c_nationkey", 4).alias("c_nationkey"))


@query("knn_impute_orders", _knn_sql("orders", "o_orderkey", "o_totalprice", "o_orderstatus = 'P'",
                                     ["o_custkey", "o_orderkey"]))
def knn_impute_orders(spark, folder):
    """A third of all rows has a gap."""
    rows = _with_gaps(table(spark, folder, "orders"), "o_totalprice", F.col("o_orderstatus") == "P")
    filled = neighbours.knn_impute(rows.withColumn("near", F.col("o_orderkey")), "o_orderkey", "o_totalprice",
                                   ["o_custkey", "near"])
    return filled.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


@query("knn_impute_partial", """
    WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v,
                      CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey::DOUBLE END AS x,
                      CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey::DOUBLE END AS y FROM orders),
         p AS (SELECT q.o_orderkey, d.v, d.o_orderkey AS k, (coalesce(pow(q.x - d.x, 2), 0) + coalesce(pow(q.y - d.y, 2), 0))
                      * 2 / ((q.x IS NOT NULL AND d.x IS NOT NULL)::INT + (q.y IS NOT NULL AND d.y IS NOT NULL)::INT) AS d2
               FROM s AS q, s AS d WHERE q.v IS NULL AND d.v IS NOT NULL
                 AND (q.x IS NOT NULL AND d.x IS NOT NULL OR q.y IS NOT NULL AND d.y IS NOT NULL)),
         n AS (SELECT o_orderkey, v, sqrt(d2) AS dist FROM p
               QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY sqrt(d2), k) <= 5),
         f AS (SELECT o_orderkey, coalesce(avg(v) FILTER (dist = 0), sum(CASE WHEN dist > 0 THEN v / dist END)
                   / sum(CASE WHEN dist > 0 THEN 1 / dist END)) AS v FROM n GROUP BY 1)
    SELECT s.o_orderkey, round(coalesce(s.v, f.v, (SELECT avg(v) FROM s)), 6) AS v FROM s LEFT JOIN f USING (o_orderkey)""")
def knn_impute_partial(spark, folder):
    """Coordinates missing on both sides: distances over the shared ones, rescaled."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"),
        F.when(F.pmod("o_orderkey", F.lit(7)) != 0, F.col("o_custkey").cast("double")).alias("x"),
        F.when(F.pmod("o_orderkey", F.lit(5)) != 0, F.col("o_orderkey").cast("double")).alias("y"))
    filled = neighbours.knn_impute(rows, "o_orderkey", "v", ["x", "y"])
    return filled.select("o_orderkey", F.round("v", 6).alias("v"))


_WIDE = 20


@query("corr_pairs_wide", f"""
    WITH w AS (SELECT {", ".join(
        f"CASE WHEN l_orderkey % {i + 3} <> 0 THEN l_extendedprice * {i} + l_quantity * {(i * 7) % 11} * 1000 + l_tax * 9e5 END AS c{i}"
        for i in range(_WIDE))} FROM lineitem)
    """ + " UNION ALL ".join(f"SELECT 'c{i}' AS a, 'c{j}' AS b, round(corr(c{i}, c{j}), 6) AS r FROM w"
                             for i in range(_WIDE) for j in range(i + 1, _WIDE)))
def corr_pairs_wide(spark, folder):
    """Twenty columns, each with nulls of its own: one pass."""
    rows = table(spark, folder, "lineitem").select(*[
        F.when(F.pmod("l_orderkey", F.lit(i + 3)) != 0, F.col("l_extendedprice") * i + F.col("l_quantity") * ((i * 7) % 11) * 1000
               + F.col("l_tax") * 9e5).alias(f"c{i}") for i in range(_WIDE)])
    found = outliers.correlations(rows, rows.columns)
    return spark.createDataFrame([(a, b, round(r, 6)) for (a, b), r in found.items()], "a string, b string, r double")


_TILED = 150
_TILED_PAIRS = [(i, j) for i in range(0, _TILED, 7) for j in (i + 1, i + 75) if j < _TILED]


def _tiled_sql(i):
    return (f"CASE WHEN l_orderkey % {i % 17 + 3} <> 0 THEN l_extendedprice * {i * 37 % 11 + 1} + l_quantity * {i * 7 % 13 * 1000}"
            f" + l_tax * {i * 5 % 7}e5 END")


@query("corr_tiles", " UNION ALL ".join(
    f"SELECT 'c{i}' AS a, 'c{j}' AS b, round(corr({_tiled_sql(i)}, {_tiled_sql(j)}), 6) AS r FROM lineitem"
    for i, j in _TILED_PAIRS))
def corr_tiles(spark, folder):
    """A hundred and fifty columns, each with nulls of its own, tile by tile; some of the pairs are looked at."""
    rows = table(spark, folder, "lineitem").select(*[F.expr(_tiled_sql(i)).alias(f"c{i}") for i in range(_TILED)])
    pairs = gram.correlation_pairs(rows, rows.columns)
    wanted = spark.createDataFrame(_TILED_PAIRS, "i int, j int")
    return pairs.join(wanted, ["i", "j"]).select(F.concat(F.lit("c"), F.col("i").cast("string")).alias("a"),
                                                 F.concat(F.lit("c"), F.col("j").cast("string")).alias("b"),
                                                 F.round("r", 6).alias("r"))


@query("standard_scale", """
    WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS dq, avg(l_tax) AS mt, stddev_pop(l_tax) AS dt
               FROM lineitem)
    SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / dq, 6) AS l_quantity,
           round((l_tax - mt) / dt, 6) AS l_tax FROM lineitem, s""")
def standard_scale(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    scaled = scale.standard_scale(rows, ["l_quantity", "l_tax"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


@query("power_transform", """
    SELECT c_custkey, round(CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1, 0.5) - 1) / 0.5
        ELSE -(pow(1 - c_acctbal, 1.5) - 1) / 1.5 END, 6) AS c_acctbal FROM customer""")
def power_transform(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    changed = scale.power_transform(rows, {"c_acctbal": 0.5}, standardise=False)
    return changed.withColumn("c_acctbal", F.round("c_acctbal", 6))


def _power_sql(column):
    """The best power on a grid of hundredths."""
    y = """CASE WHEN x >= 0 THEN CASE WHEN p = 0 THEN ln(x + 1) ELSE (pow(x + 1, p) - 1) / p END
        ELSE CASE WHEN p = 2 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - p) - 1) / (2 - p) END END"""
    return f"""SELECT '{column}' AS column, arg_max(p, score) AS power FROM (
        SELECT p, -count(*) / 2 * ln(var_pop({y})) + (p - 1) * sum(sign(x) * ln(abs(x) + 1)) AS score
        FROM (SELECT {column}::DOUBLE AS x FROM events), (SELECT unnest(range(-100, 201)) / 100 AS p) GROUP BY p)"""


@query("power_fit", _power_sql("value") + " UNION ALL " + _power_sql("user_id"))
def power_fit(spark, folder):
    events = table(spark, folder, "events")
    powers = scale.fit_powers(events, ["value", "user_id"])
    return spark.createDataFrame([(c, round(p, 2)) for c, p in powers.items()], "column string, power double")


@query("hash_split", """
    SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || ':123'), 1, 8))::BIGINT < 858993459 AS is_test FROM orders""")
def hash_split(spark, folder):
    train, test = scale.hash_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query("pca_ratio", """
    WITH t AS (SELECT l_quantity AS x, l_quantity + l_tax * 200 AS y FROM lineitem
               WHERE ('0x' || substr(md5(l_orderkey || ':123'), 1, 8))::BIGINT >= 858993459),
         c AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS d FROM t)
    SELECT round((a + d + sqrt((a - d) * (a - d) + 4 * b * b)) / 2 / (a + d), 6) AS first_ratio FROM c""")
def pca_ratio(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("mixed", F.col("l_quantity") + F.col("l_tax") * 200)
    train, test = scale.hash_split(rows, "l_orderkey")
    train, test = (scale.assemble(df, ["l_quantity", "mixed"], "l_tax", ["l_orderkey"]) for df in (train, test))
    ratios = scale.pca_to_variance(train, test)[2]
    return spark.createDataFrame([(round(ratios[0], 6),)], "first_ratio double")


_SPLIT = "('0x' || substr(md5({key} || ':123'), 1, 8))::BIGINT < 858993459"


@query("pca_variance", f"""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_quantity + l_tax * 200 AS y, l_discount AS label,
                      {_SPLIT.format(key="l_orderkey")} AS is_test FROM lineitem),
         m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS d
               FROM r WHERE NOT is_test),
         e AS (SELECT *, (a + d + sqrt((a - d) * (a - d) + 4 * b * b)) / 2 AS top FROM m),
         v AS (SELECT *, b / sqrt(b * b + (top - a) * (top - a)) AS vx, (top - a) / sqrt(b * b + (top - a) * (top - a)) AS vy
               FROM e)
    SELECT l_orderkey, l_linenumber, label, is_test, round(pow((x - mx) * vx + (y - my) * vy, 2), 5) AS first_squared,
           round(pow(x - mx, 2) + pow(y - my, 2), 5) AS length_squared, round(top / (a + d), 6) AS first_ratio
    FROM r, v""")
def pca_variance(spark, folder):
    """Both components of two columns: the first one squared, as its sign is free, and the length, which stays."""
    rows = table(spark, folder, "lineitem").withColumn("mixed", F.col("l_quantity") + F.col("l_tax") * 200)
    train, test = scale.hash_split(rows, "l_orderkey")
    train, test = (scale.assemble(df, ["l_quantity", "mixed"], "l_discount", ["l_orderkey", "l_linenumber"])
                   for df in (train, test))
    train, test, ratios = scale.pca_to_variance(train, test, 1.0)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    part = vector_to_array("features")
    return both.select("l_orderkey", "l_linenumber", "label", "is_test", F.round(part[0] * part[0], 5).alias("first_squared"),
                       F.round(part[0] * part[0] + part[1] * part[1], 5).alias("length_squared"),
                       F.lit(round(ratios[0], 6)).alias("first_ratio"))


@query("build_features", f"""
    WITH c AS (SELECT 'c' || c_custkey AS id, c_custkey / 100 AS latitude, c_acctbal AS price,
                      CASE WHEN c_nationkey <> 3 THEN c_nationkey::DOUBLE END AS nation,
                      (c_custkey % 40 = 0)::INTEGER AS rare, c_mktsegment AS segment FROM customer),
         n AS (SELECT q.id, d.nation, sqrt(pow(q.latitude - d.latitude, 2) + pow(q.price - d.price, 2)) AS dist
               FROM c AS q, c AS d WHERE q.nation IS NULL AND d.nation IS NOT NULL QUALIFY row_number() OVER (
                   PARTITION BY q.id ORDER BY pow(q.latitude - d.latitude, 2) + pow(q.price - d.price, 2), d.id) <= 5),
         f AS (SELECT id, coalesce(avg(nation) FILTER (dist = 0), sum(CASE WHEN dist > 0 THEN nation / dist END)
                   / sum(CASE WHEN dist > 0 THEN 1 / dist END)) AS filled FROM n GROUP BY id),
         i AS (SELECT c.* REPLACE (coalesce(nation, filled) AS nation) FROM c LEFT JOIN f USING (id)),
         a AS (SELECT i.* FROM i, (SELECT avg(price) AS m, stddev_pop(price) AS d FROM i) WHERE abs((price - m) / d) < 3),
         o AS (SELECT a.* FROM a, (SELECT avg(nation) AS m, stddev_pop(nation) AS d FROM a) WHERE abs((nation - m) / d) < 3),
         s AS (SELECT avg(latitude) AS lm, stddev_pop(latitude) AS ls, avg(nation) AS nm, stddev_pop(nation) AS ns,
                      avg(rare) AS rm, stddev_pop(rare) AS rs FROM o)
    SELECT id, price AS label, round((latitude - lm) / ls, 4) AS latitude, round((nation - nm) / ns, 4) AS nation,
           round((rare - rm) / rs, 4) AS rare, {", ".join(f"(segment = '{x}')::DOUBLE AS {x.lower()}" for x in
                                                          ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))},
           {_SPLIT.format(key="id")} AS is_test FROM o, s""")
def features_built(spark, folder):
    """A text key, a column to impute, a copy to drop, a constant, a rare token, a column without values; defaults."""
    rows = table(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), (F.col("c_custkey") / 100).alias("latitude"),
        F.col("c_acctbal").alias("price"), F.nullif("c_nationkey", F.lit(3)).cast("double").alias("nation"),
        (F.pmod("c_custkey", F.lit(40)) == 0).cast("int").alias("rare"), F.col("c_mktsegment").alias("segment"),
        (F.col("c_custkey") / 50 + 1).alias("mirrored"))
    built = build_features(rows, FeatureConfig(key="id", target="price", impute_on=["latitude", "price"]))
    return _flat(built, {"latitude": 4, "nation": 4, "rare": 4, "segment_BUILDING": 0, "segment_FURNITURE": 0,
                         "segment_HOUSEHOLD": 0, "segment_MACHINERY": 0}, "id")


def _flat(built, columns, key):
    """Chosen feature columns, rounded, with key, label and side."""
    place, value = {c: i for i, c in enumerate(built.columns)}, vector_to_array("features")
    both = built.train.withColumn("is_test", F.lit(False)).unionByName(built.test.withColumn("is_test", F.lit(True)))
    return both.select(key, "label", "is_test", *[F.round(value[place[c]], d).alias(c.removeprefix("segment_").lower())
                                                  for c, d in columns.items()])


@query("features_scaled", """
    WITH z AS (SELECT * FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders)
               WHERE abs((o_totalprice - m) / d) < 3),
         y AS (SELECT z.* FROM z, (SELECT avg(o_custkey) AS cm, stddev_pop(o_custkey) AS cd FROM z)
               WHERE abs((o_custkey - cm) / cd) < 3),
         s AS (SELECT avg(o_custkey) AS sm, stddev_pop(o_custkey) AS sd FROM y)
    SELECT o_orderkey, o_totalprice AS label, round((o_custkey - sm) / sd, 6) AS customer,
           (o_orderstatus = 'O')::DOUBLE AS status_o, (o_orderstatus = 'P')::DOUBLE AS status_p,
           ('0x' || substr(md5(o_orderkey || ':123'), 1, 8))::BIGINT < 858993459 AS is_test FROM y, s""")
def features_scaled(spark, folder):
    """The composite step without neighbours: outliers, scaling, indicators, split."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")
    built = build_features(rows, FeatureConfig(
        key="o_orderkey", target="o_totalprice", impute=None, outlier_columns=["o_totalprice", "o_custkey"]))
    place = {c: i for i, c in enumerate(built.columns)}
    both = built.train.withColumn("is_test", F.lit(False)).unionByName(built.test.withColumn("is_test", F.lit(True)))
    value = vector_to_array("features")
    return both.select(
        "o_orderkey", "label", F.round(value[place["o_custkey"]], 6).alias("customer"),
        value[place["o_orderstatus_O"]].alias("status_o"), value[place["o_orderstatus_P"]].alias("status_p"), "is_test")


@query("pca_sketch", """
    WITH s AS (SELECT var_samp(l_quantity::DOUBLE) AS a, var_samp(l_extendedprice::DOUBLE / 1000) AS c,
                      covar_samp(l_quantity::DOUBLE, l_extendedprice::DOUBLE / 1000) AS b FROM lineitem),
         e AS (SELECT a + c AS whole, (a + c) / 2 + sqrt(((a - c) / 2) ^ 2 + b * b) AS high FROM s)
    SELECT 1 AS component, round(high, 4) AS variance, round(high / whole, 6) AS ratio FROM e
    UNION ALL SELECT 2, round(whole - high, 4), round(1 - high / whole, 6) FROM e""")
def pca_sketch(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.array(F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double") / 1000).alias("features"))
    fitted = sketch_pca.fit(rows, 2)
    return spark.createDataFrame([(i + 1, round(float(v), 4), round(float(r), 6)) for i, (v, r) in enumerate(
        zip(fitted.variance, fitted.ratios))], "component int, variance double, ratio double")
