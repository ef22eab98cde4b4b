"""Profiling and typing. The test tables hold no nulls, so they are derived with `nullif`."""

from pyspark.sql import functions as F

from kamienica.contract.registry import query, table
from kamienica.operators import encode, profile, profile_state
from kamienica.session import settle


def gappy_parts(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        F.nullif("p_size", F.lit(7)).alias("p_size"), F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"),
        "p_retailprice")


GAPPY_SQL = """(SELECT p_partkey, nullif(p_type, 'PROMO') AS p_type, nullif(p_size, 7) AS p_size,
    nullif(p_brand, 'Brand#1') AS p_brand, p_retailprice FROM part)"""


@query("null_counts", f"""
    SELECT * FROM (SELECT 'p_type' AS column, count(*) - count(p_type) AS nulls FROM {GAPPY_SQL}
        UNION ALL SELECT 'p_size', count(*) - count(p_size) FROM {GAPPY_SQL}
        UNION ALL SELECT 'p_brand', count(*) - count(p_brand) FROM {GAPPY_SQL}
        UNION ALL SELECT 'p_partkey', count(*) - count(p_partkey) FROM {GAPPY_SQL}
        UNION ALL SELECT 'p_retailprice', count(*) - count(p_retailprice) FROM {GAPPY_SQL}) WHERE nulls > 0""")
def null_counts(spark, folder):
    return profile.null_counts(gappy_parts(spark, folder))


@query("table_info", f"""
    SELECT 'p_type' AS column, count(p_type) AS non_null, 'string' AS type FROM {GAPPY_SQL}
    UNION ALL SELECT 'p_size', count(p_size), 'int' FROM {GAPPY_SQL}
    UNION ALL SELECT 'p_brand', count(p_brand), 'string' FROM {GAPPY_SQL}
    UNION ALL SELECT 'p_partkey', count(p_partkey), 'bigint' FROM {GAPPY_SQL}
    UNION ALL SELECT 'p_retailprice', count(p_retailprice), 'double' FROM {GAPPY_SQL}""")
def table_info(spark, folder):
    return profile.table_info(gappy_parts(spark, folder))


@query("dropna_subset", f"SELECT * FROM {GAPPY_SQL} WHERE p_type IS NOT NULL AND p_size IS NOT NULL")
def dropna_subset(spark, folder):
    return profile.drop_rows_missing(gappy_parts(spark, folder), ["p_type", "p_size"])


@query("dropna_thresh", f"""
    SELECT * FROM {GAPPY_SQL} WHERE 2 + (p_type IS NOT NULL)::INT + (p_size IS NOT NULL)::INT
        + (p_brand IS NOT NULL)::INT >= 4""")
def dropna_thresh(spark, folder):
    return profile.drop_sparse_rows(gappy_parts(spark, folder), 4)


@query("drop_sparse_columns", "SELECT p_partkey, nullif(p_size, 7) AS p_size, p_retailprice FROM part")
def drop_sparse_columns(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_type") == "PROMO", F.col("p_type")).alias("p_type"),
        F.nullif("p_size", F.lit(7)).alias("p_size"), "p_retailprice")
    return profile.drop_sparse_columns(part, part.count() // 2)


@query("fill_constant", f"""
    SELECT p_partkey, coalesce(p_type, 'to_fill') AS p_type, coalesce(p_size, 404) AS p_size,
           coalesce(p_brand, 'Brak') AS p_brand, p_retailprice FROM {GAPPY_SQL}""")
def fill_constant(spark, folder):
    return profile.fill(gappy_parts(spark, folder), {"p_type": "to_fill", "p_size": 404, "p_brand": "Brak"})


def _number_sql(c):
    return f"""SELECT '{c}' AS column, count({c}) AS count, NULL::BIGINT AS unique, NULL::VARCHAR AS top,
        NULL::BIGINT AS freq, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std, min({c})::DOUBLE AS min,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75, max({c})::DOUBLE AS max,
        NULL::VARCHAR AS earliest, NULL::VARCHAR AS latest FROM events"""


def _text_sql(c, value=None, ends="NULL, NULL"):
    value = value or c
    return f"""SELECT '{c}', sum(n)::BIGINT, count(*), arg_min({c}, (-n, md5({c}))), max(n), NULL, NULL, NULL, NULL, NULL,
        NULL, NULL, {ends} FROM (SELECT {c}, count(*) AS n FROM (SELECT {value} AS {c} FROM events) GROUP BY 1)"""


@query("describe_all", " UNION ALL ".join(
    [_number_sql(c) for c in ("event_id", "user_id", "value")] + [_text_sql(c) for c in ("event_type", "props")]
    + [_text_sql("ts", "CAST(ts AS VARCHAR)", "min(ts), max(ts)")]))
def describe_all(spark, folder):
    described = profile.describe_all(table(spark, folder, "events"))
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query("describe_snapshots", "SELECT * EXCLUDE (earliest, latest) FROM (" + " UNION ALL ".join(
    [_number_sql(c) for c in ("event_id", "user_id", "value")] + [_text_sql(c) for c in ("event_type", "props")]) + ")")
def describe_snapshots(spark, folder):
    """States of the events of each day, written, merged, and described: equal to a description of the whole table."""
    events, day = table(spark, folder, "events"), F.to_date("ts")
    states = settle(profile_state.snapshot_states(events, day, ["event_id", "user_id", "value"], ["event_type", "props"]))
    merged = settle(profile_state.merge(states))
    described = profile_state.describe(merged, events, day)
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query("exact_quantiles", """
    SELECT 'l_extendedprice' AS column, s AS share, round(q, 6) AS value FROM (
        SELECT unnest([0.01, 0.25, 0.5, 0.99]::DOUBLE[]) AS s,
               unnest(quantile_cont(l_extendedprice, [0.01, 0.25, 0.5, 0.99])) AS q FROM lineitem)""")
def exact_quantiles(spark, folder):
    """The bracketing way, forced by a low limit of distinct values."""
    shares = [0.01, 0.25, 0.5, 0.99]
    found = profile.exact_quantiles(table(spark, folder, "lineitem"), ["l_extendedprice"], shares, 1000)
    return spark.createDataFrame([("l_extendedprice", s, round(v, 6)) for s, v in zip(
        shares, found["l_extendedprice"])], "column string, share double, value double")


@query("cast_numeric", """
    SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_size::BIGINT END AS whole,
           CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN p_size::BIGINT END AS unsigned FROM part""")
def cast_numeric(spark, folder):
    size = F.col("p_size").cast("string")
    part = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_type") == "PROMO", "unknown").otherwise(size).alias("whole"),
        F.when(F.col("p_type") == "PROMO", "?").when(F.col("p_type") == "SMALL", F.concat(F.lit("-"), size))
         .otherwise(size).alias("unsigned"))
    return profile.cast_columns(part, {"whole": "bigint", "unsigned": "unsigned"})


@query("parse_decimal", "SELECT p_partkey, p_size * 1000 + 0.5::DOUBLE AS rent FROM part")
def parse_decimal(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.concat(F.col("p_size").cast("string"), F.lit(" 000,5")).alias("rent"))
    return profile.cast_columns(part, {"rent": "decimal comma"})


@query("cast_date", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def cast_date(spark, folder):
    day = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return profile.cast_columns(table(spark, folder, "orders").select("o_orderkey", day.alias("day")), {"day": "date"})


FIRST_SEEN_SQL = """(SELECT value, row_number() OVER (ORDER BY first) - 1 AS code FROM (
    SELECT coalesce(nullif(c_mktsegment, 'BUILDING'), 'to_fill') AS value, min(c_custkey) AS first
    FROM customer GROUP BY 1))"""


@query("first_seen_codes", f"SELECT value, code FROM {FIRST_SEEN_SQL}")
def first_seen_codes(spark, folder):
    customers = table(spark, folder, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return encode.first_seen_dictionary(customers, "c_mktsegment", "c_custkey", "to_fill")
