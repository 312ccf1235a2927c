"""Where the query modules enter their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, by default under the name of its function, with the equivalent SQL."""

    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = sql
        return function

    return register
