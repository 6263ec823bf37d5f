"""Run registered queries next to their DuckDB SQL and compare whole results.

As a script: python -m tests.compare FOLDER [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET memory_limit = '6GB'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def ordered(columns, rows):
    """Rows with columns in name order, sorted as text; values keep their types."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def spark_result(spark, name: str, folder: str):
    frame = queries()[name](spark, folder)
    return ordered(frame.columns, [tuple(row) for row in frame.collect()])


def oracle_result(connection, name: str):
    cursor = connection.execute(oracle_sql()[name])
    return ordered([c[0] for c in cursor.description], cursor.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])} rows"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first differing row of {left[0]}:\n  spark  {a}\n  oracle {b}"
    return None


def main() -> None:
    from tests.session import local_session

    folder, *names = sys.argv[1:]
    spark, connection = local_session(), connect(folder)
    bad = 0
    for name in names or queries():
        started = time.time()
        mine = spark_result(spark, name, folder)
        spent = time.time() - started
        if name in oracle_sql():
            started = time.time()
            problem = difference(mine, oracle_result(connection, name))
            other = time.time() - started
        else:
            problem, other = None, 0.0
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:34} rows={len(mine[1]):7} {spent:6.2f}s duckdb {other:5.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
