"""Run registered queries and their SQL side by side and compare the rows.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 1e15 else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def connect(sf: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def session():
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compare(spark, con, sf: str, name: str, run, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    frame = run(spark, sf)
    rows = [tuple(r) for r in frame.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{len(rows)} rows, rows only, {took:.1f}s"
    started = time.time()
    result = con.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    sql_took = time.time() - started
    ours = canonical(frame.columns, rows)
    note = f"{len(rows)} rows, {took:.1f}s / sql {sql_took:.1f}s"
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} vs {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        return False, (
            f"{note}; sql {len(theirs[1])} rows; only spark {sorted(left, key=repr)[:2]};"
            f" only sql {sorted(right, key=repr)[:2]}"
        )[:1500]
    return True, note


def main() -> int:
    import __spark_entry__ as E
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), connect(args.sf)
    runs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name in args.names or runs:
        try:
            ok, note = compare(spark, con, args.sf, name, runs[name], sqls.get(name))
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:400]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        bad += [] if ok else [name]
    print(f"{len(bad)} failed: {bad}")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
