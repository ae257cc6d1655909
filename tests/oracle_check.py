"""Compare registered queries with their SQL counterparts: ``python tests/oracle_check.py [sf] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, "" if value is None else str(value)) for value in row)


def _same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return (math.isnan(left) and math.isnan(right)) or left == right
    return type(left) is type(right) and left == right


def compare(spark, connection, sf_dir: str, query, sql: str) -> tuple[str, int]:
    """``("ok", rows)`` or a description of the first difference."""
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    found = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=_key)
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}", len(found)
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=_key)
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}", len(found)
    for left, right in zip(found, expected):
        if not all(_same(a, b) for a, b in zip(left, right)):
            return f"found {left!r:.300} expected {right!r:.300}", len(found)
    return "ok", len(found)


def main(argv: list[str]) -> int:
    from tests.conftest import build_session

    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    spark = build_session()
    connection = connect(sf_dir)
    queries, sqls = contract.queries(), contract.oracle_sql()
    names = argv[1:] or list(queries)
    failures = 0
    print("without query:", set(sqls) - set(queries))
    for name in names:
        start = time.time()
        try:
            if name in sqls:
                result, rows = compare(spark, connection, sf_dir, queries[name], sqls[name])
            else:
                result, rows = "rows only", len(queries[name](spark, sf_dir).collect())
        except Exception as error:  # noqa: BLE001
            result, rows = f"{type(error).__name__}: {str(error)[:900]}", -1
        failures += result not in ("ok", "rows only")
        print(f"{name:28} {rows:7} {time.time() - start:6.1f}s  {result}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
