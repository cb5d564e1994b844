"""Compare every registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v) if STRICT else f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return (2, v.replace(tzinfo=None).isoformat())
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    if isinstance(v, dict):
        return (3, str(sorted((k, _norm(x)) for k, x in v.items())))
    return (4, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark simple type -> DuckDB type name, for the schema comparison
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT",
                 "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(df, res) -> list:
    duck_types = {d[0]: str(d[1]).upper() for d in res.description}
    out = []
    for col, t in df.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = duck_types.get(col, "?")
        if want != got and not (want == "DOUBLE" and got.startswith("DECIMAL")):
            out.append((col, t, got))
    return out


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="no oracle")
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    types = type_mismatches(df, res)
    drows = res.fetchall()
    out = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        out.update(ok=False, note=f"columns differ: {sorted(scols)} vs {sorted(dcols)}")
        return out
    if types:
        out["types"] = types
    a, b = canon(scols, srows), canon(dcols, drows)
    if a == b:
        out["ok"] = True
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out.update(ok=False, note=f"values differ, first: {diff}")
    return out


def main(argv):
    from strata.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls.get(name), con)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e)[:300]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
