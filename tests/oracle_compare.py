"""Local twin of the driver's correctness gate.

Runs each ``queries()`` entry in Spark and its ``oracle_sql()`` twin in
DuckDB on the same parquet tables, then compares row count, column names
and an order-insensitive value digest (columns sorted by name, floats
rounded to 9 significant digits).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EXACT = os.environ.get("EXACT") == "1"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def duck_conn(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_conn(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows), ts)
            if verbose:
                print(f"{name:28s} rows-only  spark={len(srows)}  {ts:.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        c1, r1 = canon(scols, srows)
        c2, r2 = canon(dcols, drows)
        ok = (c1 == c2, len(r1) == len(r2), r1 == r2)
        results[name] = (all(ok), ok, ts)
        if verbose:
            tag = "OK " if all(ok) else "BAD"
            print(f"{name:28s} {tag} cols={ok[0]} rows={len(r1)}/{len(r2)} vals={ok[2]}  {ts:.1f}s", flush=True)
            if not all(ok):
                if not ok[0]:
                    print("   spark:", c1, "\n   duck: ", c2)
                bad = [(a, b) for a, b in zip(r1, r2) if a != b][:3]
                for a, b in bad:
                    print("   S", a, "\n   D", b)
    return results


if __name__ == "__main__":
    from txnlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    import json

    extra = json.loads(os.environ.get("EXTRA_CONF", "{}"))
    if os.environ.get("SESSION_TZ"):
        extra["spark.sql.session.timeZone"] = os.environ["SESSION_TZ"]
    spark = build_session(extra=extra or None)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] is False]
    print("FAILED:", bad if bad else "none")
