"""Compares registered queries with their SQL equivalents: ``python tests/check_oracles.py [sf_dir] [names...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return f"{v + 0.0:.6f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark, con, name, sf_dir):
    """(ok, message) of one query."""
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"rows={len(got)} {took:.1f}s (no SQL)"
    rel = con.sql(sql)
    cols, want = list(rel.columns), rel.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}"
    a, b = rows(df.columns, got), rows(cols, want)
    if a == b:
        types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        odd = {c: (t, types[c]) for c, t in df.dtypes if (t, types[c]) not in SAME_TYPES}
        return True, f"rows={len(a)} {took:.1f}s" + (f" types {odd}" if odd else "")
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return False, f"{len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"[:1500]


SAME_TYPES = {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("date", "DATE"),
              ("timestamp_ntz", "TIMESTAMP"), ("boolean", "BOOLEAN")}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def session():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(folder)
    bad = []
    for name in sys.argv[2:] or list(entry.queries()):
        try:
            ok, message = compare(spark, con, name, folder)
        except Exception as e:  # report and go on
            ok, message = False, f"{type(e).__name__}: {str(e)[:700]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
