"""Registered queries over the driver tables and their SQL oracles.

Every query reads whole tables (or frames Spark derives from them); none
subsets rows.  Names follow SURVEY §7.3; inventory IDs are in docstrings.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if expressible) to the catalog."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_feed  # noqa: F401
    from . import queries_scalars  # noqa: F401
    from . import queries_match  # noqa: F401
    from . import queries_quality  # noqa: F401
