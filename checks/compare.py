"""Run registered queries against their SQL counterparts and report differences.

    python -m checks.compare [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(value):
    """Exact values in one notation for both engines."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (int(value) if value.is_integer() else value)
    if isinstance(value, Decimal):
        return plain(float(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def differences(spark, con, sf_dir, key, fn, sql) -> str | None:
    df = fn(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not mine:
        return "no rows"
    if mine != theirs:
        a, b = mine - theirs, theirs - mine
        return (f"{sum(mine.values())} vs {sum(theirs.values())} rows; only Spark "
                f"{sum(a.values())}: {list(a)[:2]}; only SQL {sum(b.values())}: {list(b)[:2]}")
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from checks.oracle import oracle_sql
    from checks.queries import QUERIES

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("keys", nargs="*")
    opts = args.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(opts.sf), oracle_sql(), 0
    for key in opts.keys or list(QUERIES):
        start = time.time()
        try:
            found = differences(spark, con, opts.sf, key, QUERIES[key], sql[key])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {key} {time.time() - start:.1f}s "
              f"{found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
