"""Compare registered queries with their DuckDB SQL (as the driver does):
row count, column names, and an order-insensitive hash of the values.

    python -m shardloom.plans.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as _dt
import decimal
import hashlib
import math
import sys
import time

from .registry import ORACLE, QUERIES, TABLES, load_all


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (bool, int, str)):
        return repr(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_norm(x)) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(str(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha1()
    for ln in lines:
        h.update(ln.encode())
        h.update(b"\n")
    return h.hexdigest(), lines


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, name, con=None, verbose=True):
    con = con or duck(sf_dir)
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["status"] = "rows-only"
        return res
    rel = con.sql(ORACLE[name])
    dcols = rel.columns
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and hs == hd
    res["status"] = "match" if ok else "MISMATCH"
    if not ok and verbose:
        res["cols"] = (sorted(scols), sorted(dcols))
        a, b = set(ls), set(ld)
        res["only_spark"] = sorted(a - b)[:5]
        res["only_duck"] = sorted(b - a)[:5]
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from ..session import local_session
    load_all()
    spark = local_session(8)
    con = duck(a.sf)
    bad = 0
    for n in a.names or sorted(QUERIES):
        try:
            r = compare(spark, a.sf, n, con)
        except Exception as e:  # report and go on
            msg = getattr(e, "getMessage", None)
            r = {"name": n, "status": "ERROR", "error": (msg() if callable(msg) else repr(e))[:1500]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
