"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results
(row count, column names and types, order-insensitive values).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return (1, f"{float(v):.10g}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.10g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return (3, v.isoformat())
    return (4, str(v))


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_diff(sdf, rel) -> dict:
    """Columns whose Spark and DuckDB types differ (after mapping Spark names)."""
    s = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    s_cols = sdf.columns
    types = type_diff(sdf, rel)
    ok_cols = sorted(s_cols) == sorted(d_cols) and not types
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and canon(s_cols, s_rows) == canon(d_cols, d_rows)
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    print(f"{status} {name:26s} rows spark={len(s_rows):7d} duck={len(d_rows):7d} "
          f"cols={'ok' if ok_cols else 'DIFF'} values={'ok' if ok_v else 'DIFF'} "
          f"spark={t1 - t0:5.1f}s duck={t2 - t1:4.1f}s", flush=True)
    if not ok_cols:
        print("   spark:", sorted(s_cols), "\n   duck: ", sorted(d_cols), "\n   types:", types)
    elif not ok_v:
        a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
        sa, sb = set(a), set(b)
        cols = sorted(s_cols)
        print("   cols:", cols)
        for r in sorted(sa - sb)[:5]:
            print("   only spark:", r)
        for r in sorted(sb - sa)[:5]:
            print("   only duck: ", r)
    return status == "OK "


def main(argv):
    import __spark_entry__ as E
    from visitline.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = [n for n in names if not compare(spark, n, qs[n], sqls[n], sf_dir, con)]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
