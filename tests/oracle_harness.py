"""Run registered Spark queries and their DuckDB oracles side by side.

Usable from pytest and as a script:
    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            return str(v)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    from decimal import Decimal
    if isinstance(v, Decimal):
        return round(float(v), 6)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, con=None):
    from __spark_entry__ import oracle_sql, queries
    q = queries()[name]
    sql = oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"SCHEMA {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    import collections
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if collections.Counter(map(repr, a)) == collections.Counter(map(repr, b)):
        res["status"] = "OK"
    else:
        res["status"] = "MISMATCH"
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
    return res


if __name__ == "__main__":
    from offerlens.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", 8)
    from __spark_entry__ import queries
    con = duck(sf)
    for n in names or sorted(queries()):
        try:
            r = compare(spark, sf, n, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        print(r, flush=True)
