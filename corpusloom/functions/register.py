"""Functions of the engine under SQL names, for queries that are written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .keys import _fold_keys
from .text import _nfc, match_tokens

#: SQL functions: name, arguments, result, body. They are expressions, so Catalyst sees through them.
EXPRESSIONS = (
    ("canonical_newlines", "t STRING", "STRING", r"regexp_replace(t, '\\r\\n?', '\n')"),
    ("hex_key", "t STRING", "STRING", "lower(regexp_replace(t, '[^0-9A-Za-z]+', ''))"),
    ("word_count", "t STRING", "BIGINT", r"coalesce(regexp_count(t, '[^\\s\\p{Z}\\x1c-\\x1f\\x85]+'), 0)"),
    ("letter_count", "t STRING", "BIGINT", r"coalesce(length(regexp_replace(t, '[^\\p{L}]+', '')), 0)"),
    ("nearest_ratio", "a BIGINT, b BIGINT", "DOUBLE", "CASE WHEN greatest(a, b) = 0 THEN 1D ELSE least(a, b) / greatest(a, b) END"),
)
#: Arrow functions, for what Spark has no word for.
ARROW = {"nfc": _nfc, "fold_key": _fold_keys, "match_tokens": match_tokens}


def register(spark: SparkSession, prefix: str = "cl_") -> list[str]:
    """Registers all functions for a session, replacing those of the same name; gives their names."""
    for name, arguments, result, body in EXPRESSIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {result} RETURN {body}")
    for name, function in ARROW.items():
        spark.udf.register(f"{prefix}{name}", function)
    return sorted([*(f"{prefix}{name}" for name, *_ in EXPRESSIONS), *(f"{prefix}{name}" for name in ARROW)])
