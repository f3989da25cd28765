"""Run catalogue queries next to their DuckDB oracles and compare results.

    python -m ehrspark.plans.verify [--sf DIR] [name ...]

Comparison: same column names, same row count, same multiset of rows after
sorting columns by name and rounding doubles.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import math
import os
import sys
import time

import duckdb

from ..sources.fixtures import DRIVER_TABLES
from .catalog import QUERIES
from .oracle import ORACLES, full_sql

EXTRA_TABLES = ("events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def canonical(columns, rows, digits=6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return cols, sorted(out, key=_key)


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES + EXTRA_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLES:
        res["status"] = "rows-only"
        return res
    cur = con.execute(full_sql(name))
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = canonical(s_cols, s_rows)
    dc, dr = canonical(d_cols, d_rows)
    if sc != dc:
        res["status"] = f"columns differ: {sc} vs {dc}"
    elif len(sr) != len(dr):
        res["status"] = "row count differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"values differ, e.g. {diff}"
    else:
        res["status"] = "match"
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--json", help="also write all results to this file")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session()
    con = duck_connection(a.sf)
    names = a.names or list(QUERIES)
    results = []
    for n in names:
        try:
            r = compare(spark, a.sf, n, con)
        except Exception as e:  # report and continue with the next query
            r = {"query": n, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        results.append(r)
        print(json.dumps(r, default=str), flush=True)
    bad = sum(r["status"] not in ("match", "rows-only") for r in results)
    if a.json:
        summary = {"sf_dir": a.sf, "queries": len(results),
                   "match": sum(r["status"] == "match" for r in results),
                   "rows_only": sum(r["status"] == "rows-only" for r in results),
                   "failed": bad, "results": results}
        with open(a.json, "w") as fh:
            json.dump(summary, fh, indent=1, default=str)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
