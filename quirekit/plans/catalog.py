"""All queries of the engine's own operators, with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirekit.plans import books, calls, checks, files, pages

Query = Callable[[SparkSession, str], DataFrame]

_MODULES: tuple = (books, pages, files, checks, calls)


def queries() -> dict[str, Query]:
    """Query name to callable."""
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL."""
    return {k: s for m in _MODULES for k, s in m.ORACLES.items()}
