"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
Comparison: same column names, same row count, same multiset of canonical rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.01"))) if v == v.to_integral_value() or True else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if hasattr(v, "tolist"):
        return canon(v.tolist())
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(canon(x) for x in r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(canon(x) for x in r) for r in rel.fetchall()]
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res["match"] = False
        res["why"] = f"columns {s_cols} vs {d_cols}"
        return res
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    key = lambda r: json.dumps(r, default=str)
    ss, dd = sorted(s_rows, key=key), sorted(d_rows, key=key)
    res["match"] = ss == dd
    if not res["match"]:
        sset, dset = set(map(key, ss)), set(map(key, dd))
        res["only_spark"] = list(sset - dset)[:3]
        res["only_oracle"] = list(dset - sset)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from offerboard.session import get_spark
    import __spark_entry__ as E
    spark = get_spark()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "error": str(e)[:600]}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(json.dumps(r, default=str, ensure_ascii=False), flush=True)
    print(f"# {len(names or qs)} queries, {bad} failing", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
