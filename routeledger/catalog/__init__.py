"""Registered queries and their SQL twins, one module per area."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects (query, SQL) pairs under one key."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, key: str, sql: str | None = None):
        def register(fn: Query) -> Query:
            if key in self.queries:
                raise ValueError(f"query {key} registered twice")
            self.queries[key] = fn
            if sql is not None:
                self.sql[key] = sql
            return fn
        return register

    def merge(self, other: "Registry") -> None:
        for key, fn in other.queries.items():
            self.add(key, other.sql.get(key))(fn)
