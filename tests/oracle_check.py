"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if f != f:
            return "NaN"
        if f in (float("inf"), float("-inf")):
            return str(f)
        if f == int(f) and abs(f) < 2 ** 53:
            return int(f)
        return float(f"{f:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "tinyint": "TINYINT"}


def type_mismatches(df, rel):
    duck_types = dict(zip(rel.columns, [str(t).replace(" ", "") for t in rel.types]))
    bad = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        want = t.upper().replace(" ", "") if t.startswith("decimal") else SPARK_TO_DUCK.get(t, t.upper())
        if duck_types.get(f.name) != want:
            bad.append((f.name, t, duck_types.get(f.name)))
    return bad


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    types = type_mismatches(df, rel)
    ok = sc == dc and sr == dr and not types
    res = {"name": name, "ok": ok, "rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2)}
    if types:
        res["types"] = types
    if not ok:
        res["cols"] = (sc, dc) if sc != dc else None
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["only_spark"] = diff_s
        res["only_duck"] = diff_d
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from orderflow.session import build_session
    import os
    conf = {}
    if os.environ.get("ORDERFLOW_MAX_GROUP_ROWS"):   # force the distributed scan path
        conf["orderflow.scan.maxGroupRows"] = os.environ["ORDERFLOW_MAX_GROUP_ROWS"]
    spark = build_session("local[8]", shuffle_partitions=8, conf=conf)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], sql.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "error": repr(e)[:600]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
