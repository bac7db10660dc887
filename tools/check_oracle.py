"""Run every registered query on Spark and its oracle SQL on DuckDB; compare.

usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive value hash
(columns sorted by name, floats rounded) -- the same shape as the driver's gate.
"""
from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_key(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    rows.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return cols, rows


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from marginflow.plans import all_queries
    from marginflow.session import build_session
    queries, oracle = all_queries()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    bad = 0
    for name in (names or list(queries)):
        t0 = time.time()
        try:
            sdf = queries[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: spark rows={len(sdf)} ({ts:.1f}s) no oracle")
            continue
        try:
            odf = con.execute(oracle[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = frame_key(sdf)
        oc, orows = frame_key(odf)
        if sc != oc:
            print(f"FAIL {name}: columns spark={sc} oracle={oc}")
            bad += 1
        elif len(sr) != len(orows):
            print(f"FAIL {name}: rows spark={len(sr)} oracle={len(orows)}")
            bad += 1
        elif sr != orows:
            diff = [(a, b) for a, b in zip(sr, orows) if a != b][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
        else:
            print(f"OK   {name}: rows={len(sr)} ({ts:.1f}s)")
    print(f"done: {bad} failing of {len(names or queries)}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
