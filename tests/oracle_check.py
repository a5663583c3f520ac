"""Side-by-side check of registered queries against their DuckDB oracle.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values with columns sorted by name.

    python -m tests.oracle_check [sf_dir] [name ...]

``ORACLE_TZ`` sets DuckDB's time zone (default UTC) to check that the
oracle statements do not depend on it.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute(f"SET TimeZone='{os.environ.get('ORACLE_TZ', 'UTC')}'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, repr(float(v)))
    if isinstance(v, int):
        return (2, repr(float(v)))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return (3, v.isoformat())
    if isinstance(v, dt.date):
        return (4, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (5, tuple(norm(x) for x in v))
    return (6, str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_names = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"name": name, "rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        out["status"] = f"SCHEMA {sorted(s_names)} vs {sorted(d_names)}"
        return out
    if len(s_rows) != len(d_rows):
        out["status"] = "ROWCOUNT"
        return out
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["status"] = f"VALUES {diff}"
        return out
    out["status"] = "ok"
    return out


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from meteoframe.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, orc.get(name), sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(qs) if not only else len(only)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
