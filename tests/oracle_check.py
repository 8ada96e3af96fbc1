"""Side-by-side check of registered Spark queries against their DuckDB twins.

Mirrors the driver's gate: same row count, same column names, equal multiset of rows
(columns sorted by name). Usage: python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm_val(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm_val(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm_val(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm_val(x)) for k, x in v.asDict().items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm_val(r[i]) for i in order) for r in records), key=repr)


def check(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    same = ok_cols and a == b
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "cols_ok": ok_cols, "match": same,
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if not same:
        out["spark_cols"], out["duck_cols"] = scols, dcols
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_duck"] = [r for r in b if r not in sa][:3]
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from factweave.session import get_spark
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark("local[8]", driver_memory="8g")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = check(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "error": repr(e)[:1500]}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
