"""Run registered queries beside their SQL in DuckDB and report differences.

usage: python tools/check_oracle.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return f"{type(v).__name__}:{v}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, q, sf_dir):
    t0 = time.time()
    df = q.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if q.sql is None:
        return "rows", f"{len(got)} rows", took
    cur = con.execute(q.sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return "FAIL", f"columns {sorted(df.columns)} != {sorted(cols)}", took
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return "ok", f"{len(a)} rows", took
    sa, sb = set(a), set(b)
    diff = f"spark {len(a)} rows, sql {len(b)} rows; only spark {sorted(sa - sb)[:3]}; only sql {sorted(sb - sa)[:3]}"
    return "FAIL", diff, took


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plan", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from pyspark.sql import SparkSession

    from voxlode.plans import load_all

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(a.sf)
    bad = 0
    for name, q in load_all().items():
        if a.names and not any(name == p or (p.endswith("*") and name.startswith(p[:-1])) or q.run.__module__ == p
                               or p in q.ids.split() for p in a.names):
            continue
        try:
            if a.plan:
                q.run(spark, a.sf).explain("formatted")
            status, note, took = compare(spark, con, q, a.sf)
        except Exception as e:  # noqa: BLE001
            status, note, took = "ERROR", f"{type(e).__name__}: {str(e)[:900]}", 0.0
        bad += status in ("FAIL", "ERROR")
        print(f"{status:5} {took:6.2f}s {q.ids:8} {name}: {note[:1500]}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
