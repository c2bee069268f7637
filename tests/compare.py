"""Runs registered queries beside their SQL twins and reports differences.

    python tests/compare.py [name ...]     (all names by default)
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle_connection(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 6) + 0.0
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(shaped, key=repr)


def compare(spark, con, sf, name, fn, sql):
    """None if equal, otherwise what differs; with the row count and the seconds Spark took."""
    start = time.time()
    df = fn(spark, sf)
    got = _rows(df.columns, df.collect())
    seconds = time.time() - start
    cursor = con.execute(sql)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    problem = None
    if got[0] != want[0]:
        problem = f"columns {got[0]} != {want[0]}"
    elif len(got[1]) != len(want[1]):
        problem = f"rows {len(got[1])} != {len(want[1])}"
    elif got[1] != want[1]:
        differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        problem = f"{len(differing)} of {len(got[1])} rows differ, first: {differing[0]}"
    return problem, len(got[1]), seconds


def main(names):
    from __spark_entry__ import oracle_sql, queries
    from wicklake.session import spark_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = spark_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, all_queries, oracles = oracle_connection(sf), queries(), oracle_sql()
    bad = 0
    for name in names or all_queries:
        try:
            problem, count, seconds = compare(spark, con, sf, name, all_queries[name], oracles[name])
        except Exception as exc:  # report and go on
            problem, count, seconds = f"{type(exc).__name__}: {str(exc)[:1500]}", 0, 0.0
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {count:7d} rows {seconds:6.2f} s {problem or ''}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
