"""The registered queries and, for each that SQL can express, an independent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; ``oracle`` computes the same result from the same tables."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def load_queries() -> dict[str, Query]:
    """All queries; importing the modules registers them."""
    from shelfcast.queries import (  # noqa: F401
        aggregates, encodings, joins, loading, modelling, projections, sources, windows,
    )

    return QUERIES
