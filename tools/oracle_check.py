"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [query ...]

Rows are compared as multisets after sorting columns by name, the way the
driver's correctness gate compares them.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return ("0null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("1nan",)
        return ("2num", round(v, 6))
    if isinstance(v, bool):
        return ("2num", int(v))
    if isinstance(v, (int, decimal.Decimal)):
        return ("2num", decimal.Decimal(v).normalize())
    if isinstance(v, dt.datetime):
        return ("3ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("4date", v.isoformat())
    return ("5str", str(v))


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return names, data


def compare(spark, sf_dir: str, names=None, con=None) -> dict:
    from stratum.queries import ORACLES, QUERIES

    con = con or duckdb_connection(sf_dir)
    results = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        s_rows = [tuple(r) for r in df.collect()]
        s_cols = df.columns
        t1 = time.time()
        out = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        sql = ORACLES.get(name)
        if sql is not None:
            rel = con.sql(sql)
            o_cols = rel.columns
            o_rows = rel.fetchall()
            sn, sd = normalise(s_cols, s_rows)
            on, od = normalise(o_cols, o_rows)
            out.update(
                oracle_rows=len(o_rows),
                columns_match=sn == on,
                values_match=sd == od,
            )
            if sn != on:
                out["spark_columns"], out["oracle_columns"] = sn, on
            elif sd != od:
                sset, oset = set(sd), set(od)
                out["spark_only"] = [str(x) for x in list(sset - oset)[:3]]
                out["oracle_only"] = [str(x) for x in list(oset - sset)[:3]]
        results[name] = out
    return results


def main() -> int:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, names)
    ok = True
    for name, out in res.items():
        good = out.get("values_match", True) and out.get("columns_match", True)
        ok &= good
        print(("OK  " if good else "FAIL"), name, json.dumps(out, default=str))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
