"""Compare a Spark query with its SQL in DuckDB, as the driver does; usable from the shell: python tests/compare.py [name…]."""

from __future__ import annotations

import glob
import hashlib
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


def duck(sf_dir: str = DIR):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        src = p if os.path.isfile(p) else f"{p}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    return con


def canon(df: pd.DataFrame) -> tuple[list[str], int, str]:
    cols = sorted(df.columns)

    def text(v):
        if isinstance(v, np.ndarray):
            v = v.tolist()
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(map(text, v)) + "]"
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "∅"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (float, np.floating)) or v.__class__.__name__ == "Decimal":
            f = round(float(v), 6)
            return str(int(f)) if f == int(f) else repr(f)
        return str(v)

    rows = sorted("\x1f".join(map(text, r)) for r in df[cols].itertuples(index=False, name=None))
    return cols, len(rows), hashlib.md5("\n".join(rows).encode()).hexdigest()


def compare(spark, con, name, fn, sql, sf_dir=DIR, show=True) -> bool:
    t = time.time()
    a = fn(spark, sf_dir).toPandas()
    s = time.time() - t
    b = con.execute(sql).df()
    ok = canon(a) == canon(b)
    if show:
        print(("ok  " if ok else "FAIL"), name, f"{s:.1f}s", len(a), len(b), flush=True)
        if not ok:
            cols = sorted(set(a.columns) & set(b.columns))
            print(sorted(a.columns), sorted(b.columns))
            x, y = (set(d[cols].astype(str).itertuples(index=False, name=None)) for d in (a, b))
            print(" spark only", sorted(x - y)[:4], "\n duck only ", sorted(y - x)[:4])
    return ok


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from heddle.session import session

    spark = session(master="local[8]", **{"spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    q, o = e.queries(), e.oracle_sql()
    names = sys.argv[1:] or list(q)
    con, bad = duck(), []
    for n in names:
        try:
            if n in o:
                if not compare(spark, con, n, q[n], o[n]):
                    bad.append(n)
            else:
                t = time.time()
                print("rows", n, q[n](spark, DIR).count(), f"{time.time() - t:.1f}s", flush=True)
        except Exception as x:
            bad.append(n)
            print("ERR ", n, str(x)[:600], flush=True)
    print("bad:", bad)
