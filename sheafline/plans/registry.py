"""The registry that query modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, and the SQL of those that SQL can express on the same tables."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(fn: Query) -> Query:
            if fn.__name__ in self.queries:
                raise ValueError(f"query {fn.__name__} is registered twice")
            self.queries[fn.__name__] = fn
            if sql:
                self.sql[fn.__name__] = sql
            return fn

        return add
