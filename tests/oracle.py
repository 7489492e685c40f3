"""Run registered queries beside their SQL in DuckDB and compare values.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("relink-check")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(int(v)) if v == v.to_integral_value() else repr(float(v))
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, name, fn, sql):
    """(ok, message)."""
    started = time.time()
    df = fn(spark, sf)
    got = df.collect()
    took = time.time() - started
    cols, mine = rows_of(df.columns, got)
    if sql is None:
        return True, f"{len(mine)} rows, no SQL, {took:.2f}s"
    cur = con.execute(sql)
    theirs_cols, theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if cols != theirs_cols:
        return False, f"columns {cols} != {theirs_cols}"
    if mine != theirs:
        a, b = set(mine), set(theirs)
        return False, (f"{len(mine)} vs {len(theirs)} rows; only Spark {sorted(a - b)[:3]}; only SQL {sorted(b - a)[:3]}")
    return True, f"{len(mine)} rows, {took:.2f}s"


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    spark, con = session(), duck(sf)
    names = [n for n in entry.queries() if len(argv) < 2 or any(n.startswith(a) for a in argv[1:])]
    bad = 0
    for name in names:
        try:
            ok, message = compare(spark, con, sf, name, entry.queries()[name], entry.oracle_sql().get(name))
        except Exception as e:
            ok, message = False, "".join(traceback.format_exception_only(type(e), e))[:700]
        bad += not ok
        print("ok  " if ok else "BAD ", name, message, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
