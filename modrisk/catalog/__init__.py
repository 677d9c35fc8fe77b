"""Named queries over the supplied tables, each with an independent SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL it is covered by tests instead."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def load_all() -> None:
    from modrisk.catalog import corpus, learning, records, scores, tables  # noqa: F401
