"""Compare a registered Spark query with its DuckDB oracle the way the
round driver does: sorted column names, row count, order-insensitive hash of
the values.  Usable from pytest and from the command line:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(cols: list[str], rows: list[tuple]) -> tuple[str, list]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    h = hashlib.sha256(repr(normed).encode()).hexdigest()
    return h, normed


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out["oracle_rows"] = len(o_rows)
    out["cols_match"] = sorted(s_cols) == sorted(o_cols)
    if not out["cols_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(o_cols)
    hs, ns = _digest(s_cols, s_rows)
    ho, no = _digest(o_cols, o_rows)
    out["hash_match"] = hs == ho
    if not out["hash_match"] and out["cols_match"]:
        so, oo = set(ns), set(no)
        out["only_spark"] = list(so - oo)[:3]
        out["only_oracle"] = list(oo - so)[:3]
    return out


if __name__ == "__main__":
    from sensorlake.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries

    con = duck(sf)
    bad = 0
    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": repr(e)[:400]}
        ok = r.get("hash_match") or r.get("oracle") == "none"
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print("failures:", bad)
