"""Runs a query in Spark and its SQL twin in DuckDB and compares whole results.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(frame, con, sql: str) -> list[str]:
    """Differences as messages; empty when both results are the same."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = _sorted_rows(columns, result.fetchall())
    problems = []
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} vs {sorted(columns)}"]
    for name, kind in frame.dtypes:
        if _KINDS.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} vs {kinds[name]}")
    actual = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} vs {len(expected)}")
    if actual != expected:
        left, right = set(map(repr, actual)), set(map(repr, expected))
        problems.append(f"only spark {sorted(left - right)[:2]} only sql {sorted(right - left)[:2]}"[:1500])
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from modrisk.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        sql = entry.oracle_sql().get(name)
        start = time.time()
        try:
            frame = build(spark, sf_dir)
            if sql is None:
                n = len(frame.collect())
                print(f"rows  {name} {n} ({time.time() - start:.1f}s)", flush=True)
                continue
            problems = compare(frame, con, sql)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name} ({time.time() - start:.1f}s)", flush=True)
        for p in problems:
            print("     ", p)
    print("bad:", bad)


if __name__ == "__main__":
    main()
