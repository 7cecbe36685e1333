"""Run registered queries and their SQL twins and compare the rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            files = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when rows, column names and kinds of types agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    want = rows_of(columns, result.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if want == got:
        return None if want else "both empty"
    extra, missing = got - want, want - got
    return (
        f"rows {sum(got.values())} / {sum(want.values())}, extra {sum(extra.values())}, missing {sum(missing.values())}; "
        f"{sorted(extra, key=str)[:2]} vs {sorted(missing, key=str)[:2]}"
    )


def main() -> None:
    from clickwatch.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("compare", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            verdict = difference(df, con, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as e:  # report and go on with the next query
            verdict = "ERROR " + str(e)[:600]
        bad += bool(verdict) and name in oracle
        print(f"{name:32s} {time.time() - start:6.2f}s  {verdict or 'equal'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
