"""Runs registered queries next to their SQL and compares the rows.

``python tests/compare.py SF_DIR [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def normal(columns, rows):
    """Rows as tuples in column-name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return type(a) is type(b) and a == b


def difference(spark_df, con, sql: str) -> str:
    """Empty when both sides hold the same rows under the same column names."""
    found = con.execute(sql)
    sql_columns = [d[0] for d in found.description]
    expected = normal(sql_columns, found.fetchall())
    got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(sql_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(sql_columns)}"
    if len(expected) != len(got):
        return f"{len(got)} rows against {len(expected)}"
    for a, b in zip(got, expected):
        if not all(map(same, a, b)):
            return f"{a} against {b}"
    return "" if got else "no rows on either side"


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from logblocks.session import local_session

    spark = local_session()
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            wrong = difference(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the other queries
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(wrong) and name in sql
        print(f"{'ok  ' if not wrong else 'DIFF'} {name} {time.time() - start:.2f}s {wrong[:700]}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
