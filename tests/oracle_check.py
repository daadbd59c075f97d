"""Compare a registered Spark query with its DuckDB statement (used by tests and by hand).

    python -m tests.oracle_check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    dk = con.execute(sql).df()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(sp), "oracle_rows": len(dk), "spark_s": round(t1 - t0, 2),
           "oracle_s": round(t2 - t1, 2), "cols_equal": sorted(sp.columns) == sorted(dk.columns)}
    if res["cols_equal"]:
        a, b = canon(sp), canon(dk)
        res["values_equal"] = a == b
        if not res["values_equal"]:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            res["first_diffs"] = diff
    else:
        res["spark_cols"], res["oracle_cols"] = list(sp.columns), list(dk.columns)
        res["values_equal"] = False
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tastebud.session import get_spark

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    for name in names or list(qs):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print({"name": name, "spark_rows": n, "oracle": None, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            print(compare(spark, con, name, qs[name], sqls[name], sf_dir), flush=True)
        except Exception as e:  # report and continue with the next query
            print({"name": name, "error": repr(e)[:800]}, flush=True)


if __name__ == "__main__":
    main(sys.argv)
