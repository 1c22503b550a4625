"""Run a query in Spark and in SQL over the same tables, and compare rows, columns and values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(value) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, name: str, folder: str, queries, sql, connection) -> str | None:
    """None if both give the same, else what differs."""
    df = queries[name](spark, folder)
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if name not in sql:
        return None if sum(actual.values()) else "no rows"
    cursor = connection.execute(sql[name])
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    expected = rows_of(names, cursor.fetchall())
    if actual == expected:
        return None if sum(actual.values()) else "no rows on both sides"
    extra, lacking = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, {sum(expected.values())} expected; {sum(extra.values())} extra like "
        f"{sorted(extra.items(), key=str)[:2]}, {sum(lacking.values())} lacking like {sorted(lacking.items(), key=str)[:2]}"
    )


def main(argv: list[str]) -> None:
    from tidemark.catalog import QUERIES, SQL
    from tidemark.session import local_session

    folder = argv[0]
    wanted = [name for name in QUERIES if len(argv) == 1 or any(name.startswith(prefix) for prefix in argv[1:])]
    spark, connection = local_session(8), connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = differences(spark, name, folder, QUERIES, SQL, connection)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "ok " if problem is None else "BAD"
        checked = "" if name in SQL else " (rows only)"
        print(f"{mark} {name} {time.time() - start:.1f}s{checked} {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
