"""Runs a registered query and its SQL on the same tables and compares the results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return f"{type(value).__name__}:{value}"


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(columns_a: list[str], rows_a: list[tuple], columns_b: list[str], rows_b: list[tuple]) -> str | None:
    """None if equal, else what differs."""
    if sorted(columns_a) != sorted(columns_b):
        return f"columns {sorted(columns_a)} != {sorted(columns_b)}"
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} != {len(rows_b)}"
    left, right = canonical(columns_a, rows_a), canonical(columns_b, rows_b)
    for a, b in zip(left, right):
        if a != b:
            return f"values {str(a)[:600]} != {str(b)[:600]}"
    return None


def check(spark, connection, sf: str, name: str, queries, oracle) -> tuple[str | None, int, float]:
    start = time.time()
    df = queries[name](spark, sf)
    rows = [tuple(row) for row in df.collect()]
    seconds = time.time() - start
    if name not in oracle:
        return None, len(rows), seconds
    result = connection.execute(oracle[name])
    columns = [d[0] for d in result.description]
    return compare(df.columns, rows, columns, result.fetchall()), len(rows), seconds


def main() -> None:
    """python -m tests.compare SF_DIR [name-prefix ...]"""
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = session(), connect(sf)
    all_queries, oracle = queries(), oracle_sql()
    bad = 0
    for name in all_queries:
        if wanted and not any(name.startswith(prefix) for prefix in wanted):
            continue
        try:
            difference, count, seconds = check(spark, connection, sf, name, all_queries, oracle)
        except Exception as error:  # report and go on with the next query
            difference, count, seconds = f"{type(error).__name__}: {str(error)[:1500]}", -1, 0.0
        mark = "ok " if difference is None else "BAD"
        bad += difference is not None
        kind = "sql " if name in oracle else "rows"
        print(f"{mark} {kind} {name:32s} {count:7d} rows {seconds:6.2f}s {difference or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
