"""Operators for training-data pipelines, one module for each problem.

Nothing outside this package imports it. :func:`queries` and
:func:`oracle_sql` add its queries to those of ``__spark_entry__``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import consolidate, language, leakage, mixing, near_copies, quota_sample, splits, stable_sample, survivors

MODULES = (splits, stable_sample, near_copies, survivors, quota_sample, consolidate, leakage, mixing, language)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of all problems by name."""
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB, where SQL can express a query on whole tables."""
    return {name: q for m in MODULES for name, q in getattr(m, "SQL", {}).items()}
