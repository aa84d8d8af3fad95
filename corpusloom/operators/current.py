"""Tables whose rows are delivered again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], stamp: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row for each key: the one with the latest stamp.

    NULL stamps are oldest; among equal stamps the larger ``ties`` columns
    count, then the larger rest of the row, so the result does not depend on
    the order of the input. NULL keys are left out. Rows are partially
    aggregated where they lie; no key's rows are gathered.
    """
    first = [stamp, *ties]
    rest = [c for c in df.columns if c not in first and c not in keys]
    packed = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("__row"))
    return packed.select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def bottom_k(df: DataFrame, strata: Sequence[str], rank: str, key: str, k: int) -> DataFrame:
    """The k rows of smallest rank in each stratum, ties by key.

    Spark cuts each partition to k rows a stratum before the shuffle, so a
    stratum of any size sends k rows a task.
    """
    from pyspark.sql import Window

    over = Window.partitionBy(*strata).orderBy(rank, key) if strata else Window.partitionBy(F.lit(0)).orderBy(rank, key)
    return df.withColumn("__n", F.row_number().over(over)).where(F.col("__n") <= k).drop("__n")
