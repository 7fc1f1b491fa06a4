"""Run registered queries next to their SQL twins and compare values.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(root: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def difference(spark_result, oracle_result) -> str | None:
    """None when equal, else a short description. Numbers compare exactly."""
    (left_columns, left), (right_columns, right) = spark_result, oracle_result
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else None


def run_spark(spark, query, root):
    df = query(spark, root)
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def run_oracle(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return canonical(columns, cursor.fetchall())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tillmark.session import build_session

    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = connect(root), oracle_sql(), 0
    wanted = sys.argv[2:]
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            result = run_spark(spark, query, root)
            took = time.time() - started
            if name in oracles:
                problem = difference(result, run_oracle(connection, oracles[name]))
            else:
                problem = None if result[1] else "no rows"
        except Exception as error:  # report and go on with the next query
            problem, took, result = f"{type(error).__name__}: {str(error)[:600]}", time.time() - started, ((), ())
        failed += problem is not None
        state = "ok  " if problem is None else "FAIL"
        kind = "sql" if name in oracles else "rows"
        print(f"{state} {kind:4} {took:6.2f}s {len(result[1]):7d} {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
