"""Side-by-side check of a registered query against its DuckDB oracle.

Usable from pytest and as a script::

    python tests/oracle_compare.py [sf_dir] [key ...]

Comparison: same column names, same row count, same multiset of rows
(columns sorted by name, values normalised: timestamps to naive UTC,
floats exactly, NaN/None as NULL).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        if v is pd.NaT:
            return None
        if v.tzinfo is not None:
            v = v.tz_convert("UTC").tz_localize(None)
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[key](spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    sql = E.oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    dpdf = con.execute(sql).fetchdf()
    res["oracle_rows"] = len(dpdf)
    if sorted(spdf.columns) != sorted(dpdf.columns):
        res["status"] = f"columns differ: {sorted(spdf.columns)} vs {sorted(dpdf.columns)}"
        return res
    a, b = _rows(spdf), _rows(dpdf)
    if len(a) != len(b):
        res["status"] = "row count differs"
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    res["status"] = "ok" if not bad else f"{len(bad)} rows differ, e.g. {bad[0]}"
    return res


def main(argv: list[str]) -> int:
    from tillscope.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as E

    keys = argv[1:] or list(E.queries())
    spark = local_session()
    con = duck(sf_dir)
    failed = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"key": k, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        failed += r["status"] != "ok"
        print(r, flush=True)
    print(f"{len(keys) - failed}/{len(keys)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
