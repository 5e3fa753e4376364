"""Run registered queries beside their SQL and compare rows.

    python -m tests.parity [--sf 0.01] [--no-broadcast] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry
from tidemark.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return value.normalize() if value else decimal.Decimal(0)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if mine != theirs:
        return False, (
            f"{sum(mine.values())} vs {sum(theirs.values())} rows; only here "
            f"{list((mine - theirs).items())[:2]}; only there {list((theirs - mine).items())[:2]}"
        )
    return True, f"{sum(mine.values())} rows"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--no-broadcast", action="store_true", help="force shuffled joins")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), duck(sf_dir)
    if args.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    bad = 0
    for name in args.names or entry.queries():
        began = time.time()
        try:
            if name in entry.oracle_sql():
                ok, text = compare(spark, con, name, sf_dir)
            else:
                ok, text = True, f"{entry.queries()[name](spark, sf_dir).count()} rows, no SQL"
        except Exception as error:  # report and go on with the other queries
            ok, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} ({time.time() - began:.1f}s) {text}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
