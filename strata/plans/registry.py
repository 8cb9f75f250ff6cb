"""Registry of checkable queries: one Spark callable and, where SQL can say
the same, one DuckDB oracle statement per name.

Each callable takes ``(spark, sf_dir)``, reads the driver tables there (or
data Spark derives from them) and returns a DataFrame. Column names are the
same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator adding a query (and its oracle SQL) to the registry."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (they register themselves)."""
    from strata.plans import (  # noqa: F401
        queries_io,
        queries_joins,
        queries_keys,
        queries_sets,
        queries_stream,
    )
