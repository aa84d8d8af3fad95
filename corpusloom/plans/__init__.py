"""Registered queries over the tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import benchmark, collection, pairs, selection, stores, windows

MODULES = (collection, selection, pairs, benchmark, windows, stores)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of all plan modules by name."""
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB by query name."""
    return {name: q for m in MODULES for name, q in m.SQL.items()}
