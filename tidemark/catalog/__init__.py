"""Registered queries, each with the SQL that states the same result for the DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        """Register a query function, with its oracle SQL when the result can be said in SQL."""

        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if sql is not None:
                from tidemark.catalog.oracle_views import with_views

                self.oracles[name] = with_views(sql)
            return fn

        return register


catalog = Catalog()
