"""Run a registered query in Spark and its SQL oracle in DuckDB; compare the results.

Mirrors the driver's check: row count, column names, and order-insensitive values
(columns sorted by name, doubles compared after rounding).
"""

from __future__ import annotations

import math
import sys

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_frame(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False):
        out = []
        for v in rec:
            if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                out.append("<null>")
            elif isinstance(v, float):
                out.append(f"{round(v, 5):.5f}")
            elif hasattr(v, "isoformat"):
                out.append(str(v)[:10] if len(str(v)) >= 10 else str(v))
            else:
                out.append(str(v))
        rows.append(tuple(out))
    return sorted(rows)


def compare(spark, name: str, sf_dir: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    s = query(spark, sf_dir).toPandas()
    d = con.execute(sql).df()
    res = {"name": name, "spark_rows": len(s), "oracle_rows": len(d),
           "columns_match": sorted(s.columns) == sorted(d.columns)}
    if res["columns_match"]:
        a, b = _norm_frame(s), _norm_frame(d)
        res["values_match"] = a == b
        if not res["values_match"]:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            res["first_diffs"] = diff
    else:
        res["spark_cols"] = sorted(s.columns)
        res["oracle_cols"] = sorted(d.columns)
    return res


if __name__ == "__main__":
    import time
    sys.path.insert(0, "/root/repo")
    from chronofit.plans.catalog import oracle_sql, queries
    from chronofit.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8, 8)
    qs, os_ = queries(), oracle_sql()
    con = duck(sf)
    for n in names or sorted(os_):
        t = time.time()
        try:
            r = compare(spark, n, sf, qs[n], os_[n], con)
        except Exception as exc:  # report and continue
            r = {"name": n, "error": repr(exc)[:400]}
        r["sec"] = round(time.time() - t, 1)
        print(r, flush=True)
