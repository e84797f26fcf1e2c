"""Run each registered query in Spark and its oracle in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as se  # noqa: E402
from trendspark.plans.catalogue import TABLES  # noqa: E402
from trendspark.session import get_session  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "boolean": "BOOLEAN", "array<bigint>": "BIGINT[]"}


def compare(spark, con, sf, name):
    """(ok, message) for one query: columns, types, row count and value hash."""
    df = se.queries()[name](spark, sf)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    sql = se.oracle_sql().get(name)
    if sql is None:
        return True, f"rows-only {len(srows)}"
    r = con.execute(sql)
    ocols, orows = [d[0] for d in r.description], r.fetchall()
    otypes = {d[0]: str(d[1]) for d in r.description}
    sh, sl = digest(scols, srows)
    oh, ol = digest(ocols, orows)
    ok = (sorted(scols) == sorted(ocols) and stypes == otypes and len(srows) == len(orows)
          and sh == oh)
    msg = f"spark {len(srows)} rows {sorted(scols)}, oracle {len(orows)} rows {sorted(ocols)}"
    if stypes != otypes:
        msg += f"; types {stypes} vs {otypes}"
    if not ok:
        a, b = set(sl), set(ol)
        msg += f"; spark-only {list(a - b)[:2]}; oracle-only {list(b - a)[:2]}"
    return ok, msg


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_session("local[8]", 8)
    con = duck(sf)
    bad = 0
    for name in se.queries():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            ok, msg = compare(spark, con, sf, name)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {str(e)[:800]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {msg} {time.time() - t0:.1f}s")
        bad += 0 if ok else 1
    print("failures:", bad)


if __name__ == "__main__":
    main()
