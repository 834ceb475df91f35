"""Named queries, each with the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name!r} is registered twice")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return register
