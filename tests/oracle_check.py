"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle.

usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the values
(floats rounded to 6 places).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from laborlake.session import build_session  # noqa: E402
from laborlake.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "as_tuple"):  # Decimal
        return f"{round(float(v), 6):.6f}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    oracle = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        secs = time.time() - t0
        if name not in oracle:
            print(f"{name:34s} rows={len(rows):7d}  (no oracle)  {secs:.1f}s")
            continue
        cur = con.execute(oracle[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        ok = (len(rows) == len(orows) and sorted(df.columns) == sorted(ocols)
              and _digest(df.columns, rows) == _digest(ocols, orows))
        bad += not ok
        print(f"{name:34s} rows={len(rows):7d} oracle={len(orows):7d} {'OK ' if ok else 'BAD'} {secs:.1f}s"
              + ("" if sorted(df.columns) == sorted(ocols) else f" cols {sorted(df.columns)} vs {sorted(ocols)}"))
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
