"""Queries by name, each with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """(queries, SQL, decorator): the decorator registers a query under its name, with its SQL if there is any."""
    queries: dict[str, Query] = {}
    texts: dict[str, str] = {}

    def query(sql: str | None = None):
        def register(f: Query) -> Query:
            queries[f.__name__] = f
            if sql:
                texts[f.__name__] = sql
            return f

        return register

    return queries, texts, query
