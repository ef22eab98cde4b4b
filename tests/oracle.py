"""Runs queries in Spark and their SQL in DuckDB over the same files and compares the results.

    python -m tests.oracle [folder] [query ...]
"""

import glob
import math
import os
import sys
import time

import duckdb

FOLDER = "/root/testdata/sf0.01"


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
          "boolean": "BOOLEAN", "date": "DATE"}


def compare(df, connection, sql):
    """None if equal, else what differs."""
    got = df.collect()
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    wrong = [(c, k, kinds[c]) for c, k in df.dtypes if _KINDS.get(k) != kinds[c]]
    mine, theirs = rows_of(df.columns, got), rows_of(relation.columns, relation.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(mine)} rows differ, first {different[0]}"
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from kamienica.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else FOLDER
    spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            verdict = compare(df, connection, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as problem:
            verdict = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not (verdict is None or verdict.startswith("rows only"))
        print(f"{name:24} {time.time() - start:6.2f}s  {verdict or 'ok'}", flush=True)
    print("failures:", bad)
