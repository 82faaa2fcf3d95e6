"""Run every registered query in Spark and its SQL oracle in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive multiset of rows.
"""
from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from critiq.plans.registry import oracle_sql, queries  # noqa: E402
from critiq.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from '{p}'")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERROR {name}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS-ONLY {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.sql(sqls[name])
            dcols = res.columns
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"SQL-ERROR {name}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        status = "OK"
        why = ""
        if sorted(scols) != sorted(dcols):
            status, why = "COLS", f"spark={scols} sql={dcols}"
        elif len(srows) != len(drows):
            status, why = "COUNT", f"spark={len(srows)} sql={len(drows)}"
        else:
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                status, why = "VALUES", f"first diffs {diff}"
        if status != "OK":
            bad += 1
        print(f"{status} {name}: {len(srows)} rows ({ts:.1f}s) {why[:600]}", flush=True)
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
