"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

The comparison mirrors the driver's: column names sorted, row count, and the multiset of
rows (doubles compared after rounding to 6 significant decimals).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
        if isinstance(v, np.ndarray):
            return _norm(v.tolist())
    except ImportError:
        pass
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def compare(spark, con, name: str, sf_dir: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = "COLUMNS"
        res["detail"] = f"spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        res["status"] = "ROWCOUNT"
    elif s_norm != d_norm:
        res["status"] = "VALUES"
        for a, b in zip(s_norm, d_norm):
            if a != b:
                res["detail"] = f"cols={[s_cols[i] for i in order]}\nspark ={a}\noracle={b}"
                break
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from reportwide.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": "ERROR", "detail": repr(e)[:2000]}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
