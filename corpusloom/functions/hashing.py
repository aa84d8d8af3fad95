"""Stable ids and ranks.

An id is the hex SHA-256 of a namespace, one NUL byte and the parts as compact
JSON; as a hex string it sorts as the number it stands for, so it is a rank as
well. Every order that a result depends on is such a rank with the key as tie
breaker, never the order in which rows arrive.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def stable_id(namespace: str, *parts: Column | str) -> Column:
    """Hex id of the parts; a NULL part is the JSON null."""
    parts = [F.col(p) if isinstance(p, str) else p for p in parts]
    told = [F.coalesce(F.to_json(F.struct(p.cast("string").alias("x"))), F.lit("{}")) for p in parts]
    # one-field objects keep escapes right; only their values are joined
    values = [F.when(t == "{}", F.lit("null")).otherwise(F.regexp_extract(t, r'(?s)^\{"x":(.*)\}$', 1)) for t in told]
    return F.sha2(F.concat(F.lit(f"{namespace}\0["), F.concat_ws(",", *values), F.lit("]")), 256)


def stable_rank(namespace: str, seed: int | str, key: Column | str) -> Column:
    """Hex rank of a key for one seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.sha2(F.concat(F.lit(f"{namespace}\0{seed}\0"), key.cast("string")), 256)


def fast_hash(key: Column | str, seed: int = 42) -> Column:
    """xxh64 of the UTF-8 bytes as a signed whole number; in the JVM for seed 42, else in Arrow batches."""
    key = F.col(key) if isinstance(key, str) else key
    if seed == 42:
        return F.xxhash64(key.cast("string"))

    def run(values: pd.Series) -> pd.Series:
        out = [xxhash.xxh64_intdigest(v, seed & 0xFFFFFFFFFFFFFFFF) if isinstance(v, str) else None for v in values]
        return pd.Series([x if x is None or x < 2**63 else x - 2**64 for x in out], dtype="Int64")

    return F.pandas_udf(run, LongType())(key.cast("string"))


def unsigned_order(hashed: Column) -> Column:
    """A value whose signed order is the unsigned order of ``hashed``."""
    return hashed.bitwiseXOR(F.expr("-9223372036854775807L - 1L"))


def uniform(hashed: Column) -> Column:
    """A hash as a number from 0 to below 1."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(2**53))
