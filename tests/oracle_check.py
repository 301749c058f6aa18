"""Run every registered query in Spark and its oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for k in keyed:
        h.update(k.encode())
    return [columns[i] for i in order], len(rows), h.hexdigest()[:16]


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from tidemark.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols, s_n, s_h = digest(df.columns, [tuple(r) for r in df.collect()])
        except Exception as e:  # report and go on
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sql:
            print(f"ROWS  {name}: {s_n} rows ({t1 - t0:.1f}s, no oracle)")
            continue
        cur = con.execute(sql[name])
        d_cols = [c[0] for c in cur.description]
        d_cols, d_n, d_h = digest(d_cols, cur.fetchall())
        ok = (s_cols, s_n, s_h) == (d_cols, d_n, d_h)
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name}: spark {s_n} rows {s_h} / duckdb {d_n} rows {d_h}"
              f" ({t1 - t0:.1f}s)" + ("" if s_cols == d_cols else f" cols {s_cols} vs {d_cols}"))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
