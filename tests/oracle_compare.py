"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Comparison: columns sorted by name, rows as an order-insensitive multiset,
values normalised (numpy/pandas scalars, timestamps, lists). Usage:

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = cur.fetchall()
    return [names[i] for i in order], [tuple(norm(r[i]) for i in order) for r in rows]


def compare(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        scols, srows = spark_rows(df)
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:32s} rows-only  rows={len(srows)}  spark={t1-t0:.1f}s", flush=True)
            continue
        dcols, drows = duck_rows(con, sqls[name])
        ok_cols = scols == dcols
        cs, cd = collections.Counter(srows), collections.Counter(drows)
        ok = ok_cols and cs == cd
        results[name] = ("ok" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{name:32s} {'ok' if ok else 'MISMATCH'}  spark={len(srows)} duck={len(drows)}"
                  f"  spark={t1-t0:.1f}s", flush=True)
            if not ok_cols:
                print("   spark cols:", scols, "\n   duck cols: ", dcols)
            elif not ok:
                only_s = list((cs - cd).elements())[:3]
                only_d = list((cd - cs).elements())[:3]
                print("   cols:", scols)
                print("   only spark:", only_s)
                print("   only duck: ", only_d)
    return results


if __name__ == "__main__":
    from reelspark.session import build_session, checkpoint_dir
    import tempfile
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    checkpoint_dir(spark, tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("MISMATCHES:", bad)
    sys.exit(1 if bad else 0)
