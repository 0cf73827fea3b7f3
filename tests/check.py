"""Compare every query with its oracle: `python tests/check.py [--sf 0.01] [key ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(0.0 if value == 0 else value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(df, con, sql):
    """None when both sides agree, else a short text that says how they differ."""
    names = sorted(df.columns)
    got = sorted((tuple(normal(r[n]) for n in names) for r in df.collect()), key=repr)
    cursor = con.execute(sql)
    head = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(head) != names:
        return f"columns {names} != {sorted(head)}"
    index = [list(head).index(n) for n in names]
    want = sorted((tuple(normal(r[i]) for i in index) for r in cursor.fetchall()), key=repr)
    types = dict(df.dtypes)
    bad = [(n, types[n], head[n]) for n in names if TYPES.get(types[n]) != head[n]]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    if diff:
        return f"{len(diff)} of {len(got)} rows differ: {diff[:2]} columns {names}"
    return f"types {bad}" if bad else None


def main():
    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    import __spark_entry__ as entry
    from laurel.session import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    sqls, failed = entry.oracle_sql(), []
    for key, run in entry.queries().items():
        if args and not any(key == a or (a.endswith("*") and key.startswith(a[:-1])) for a in args):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if key in sqls:
                problem, kind = compare(df, con, sqls[key]), "sql"
            else:
                n = len(df.collect())
                problem, kind = (None if n else "no rows"), f"rows {n}"
        except Exception as e:
            problem, kind = f"{type(e).__name__}: {str(e)[:600]}", "error"
        print(f"{'FAIL' if problem else 'ok':5} {key:8} {time.time() - start:6.2f}s {kind} {problem or ''}", flush=True)
        if problem:
            failed.append(key)
    print("failed:", failed)


if __name__ == "__main__":
    main()
