"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Row count, column names and an order-insensitive comparison of values
(floats compared after rounding to 9 significant places).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (datetime.date,)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "sec": round(t1 - t0, 2)}
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "sec": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns {scols} vs {dcols}")
        return res
    a, b = rows_key(scols, srows), rows_key(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res.update(ok=False, why=f"values differ, e.g. {diff}")
        return res
    res["ok"] = True
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as e
    from tessera.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, orc = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as ex:  # report and go on
            r = {"name": name, "ok": False, "why": f"{type(ex).__name__}: {str(ex)[:400]}"}
            traceback.print_exc(limit=2)
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"{len(names or qs)} queries, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
