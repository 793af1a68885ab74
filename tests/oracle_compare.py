"""Run registered queries against their oracle SQL (DuckDB) and compare
row count, column names, column types and the order-insensitive multiset
of rows (floats bit-exact; set EXACT = False to compare at 9 significant
digits).

    python tests/oracle_compare.py [sf_dir] [query-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


EXACT = True   # floats must be bit-identical; False: 9 significant digits


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.9g}")
    except Exception:
        pass
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    s_rows = [r.asDict() for r in df.collect()]
    s_cols = sorted(df.columns)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad_types = {c: (t, d_types.get(c)) for c, t in s_types.items() if t != d_types.get(c)}
    if bad_types:
        return False, f"types differ: {bad_types}"
    cur = con.execute(sql)
    d_cols_raw = [d[0] for d in cur.description]
    d_rows = [dict(zip(d_cols_raw, r)) for r in cur.fetchall()]
    d_cols = sorted(d_cols_raw)
    if s_cols != d_cols:
        return False, f"columns differ: spark-only={set(s_cols)-set(d_cols)} sql-only={set(d_cols)-set(s_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"rows differ: spark={len(s_rows)} sql={len(d_rows)}"
    a = Counter(tuple(norm(r[c]) for c in s_cols) for r in s_rows)
    b = Counter(tuple(norm(r[c]) for c in s_cols) for r in d_rows)
    if a != b:
        diff_a = list((a - b).elements())[:2]
        diff_b = list((b - a).elements())[:2]
        return False, f"values differ ({sum((a-b).values())} rows): spark {diff_a} sql {diff_b} cols {s_cols}"
    return True, f"{len(s_rows)} rows"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    import __spark_entry__ as E
    from matchlab.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in sorted(qs):
        if only and not any(name.startswith(o) for o in only):
            continue
        if name not in sqls:
            print(f"--   {name:36s} (no oracle SQL)")
            continue
        t = time.time()
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'}  {name:36s} {time.time()-t:6.1f}s {msg}", flush=True)
    print(f"mismatches: {bad}")


if __name__ == "__main__":
    main()
