"""Compare queries with their DuckDB SQL: python tests/oracle.py FOLDER [NAME...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.isdir(path):
            path = f"{path}/*.parquet"
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(x):
    import datetime
    import decimal

    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def difference(df, sql: str, con) -> str:
    """Empty if both have the same columns and rows, in any order."""
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} against {sorted(rel.columns)}"
    at = [rel.columns.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a}\n  against {b}"
    types = dict(zip(rel.columns, map(str, rel.types), strict=True))
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = [f"{n}: {t} against {types[n]}" for n, t in df.dtypes if t in same and same[t] != types[n]]
    return "types " + "; ".join(odd) if odd else ""


if __name__ == "__main__":
    import __spark_entry__
    from tests.session import local_session

    spark, con, folder = local_session(), connect(sys.argv[1]), sys.argv[1]
    sql, all_queries, bad = __spark_entry__.oracle_sql(), __spark_entry__.queries(), 0
    for name in sys.argv[2:] or all_queries:
        began = time.time()
        try:
            if name in sql:
                said = difference(all_queries[name](spark, folder), sql[name], con)
            else:
                said = f"(no SQL) {len(all_queries[name](spark, folder).collect())} rows"
        except Exception as e:  # one query's failure must not hide the others'
            said = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = not said or said.startswith("(no SQL)")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - began:.1f} s {said}", flush=True)
    sys.exit(bool(bad))
