"""Compare a registered Spark query with its DuckDB oracle (row count, column
names, order-insensitive values). Usable from pytest and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6f}"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    t2 = time.time()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
    }
    if out["cols_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            diff = [x for x in a if x not in set(b)][:3]
            out["example_spark_only"] = diff
            out["example_oracle_only"] = [x for x in b if x not in set(a)][:3]
    else:
        out["values_match"] = False
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from quire.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(oracle_sql())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names:
        try:
            res = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as exc:  # report and continue
            res = {"name": name, "ok": False, "error": repr(exc)[:400]}
        bad += not res["ok"]
        print(res, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
