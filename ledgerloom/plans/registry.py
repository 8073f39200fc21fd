"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Names map to a query, an optional SQL text, and the operator ids the query exercises."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}
        self.operators: dict[str, tuple[str, ...]] = {}

    def add(self, name: str, ops: str = "", sql: str | None = None) -> Callable[[Query], Query]:
        def wrap(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            self.operators[name] = tuple(ops.split())
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return wrap


CORE = Registry()
