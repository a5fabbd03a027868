"""Run registered queries against their DuckDB SQL: python tests/compare.py [sf_dir] [key ...]."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    import datetime
    import decimal

    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return None if value != value else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list | tuple):
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=key)


def differences(df, con, sql):
    """'' when equal, else a short description."""
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if mine == theirs:
        return ""
    a, b = set(mine), set(theirs)
    return (
        f"{len(mine)} vs {len(theirs)} rows\n  only spark: {[str(r)[:300] for r in list(a - b)[:3]]}"
        f"\n  only duckdb: {[str(r)[:300] for r in list(b - a)[:3]]}"
    )


def main():
    import __spark_entry__ as entry
    from winnow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                diff = differences(df, con, sqls[name])
                n = ""
            else:
                diff, n = "", f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            diff, n = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name:24s} {time.time() - start:6.2f}s {n} {diff}", flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main()
