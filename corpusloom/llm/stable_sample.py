"""Problem 2: a reproducible sample that stays stable as data grows.

Method: hash each stable record key with a fixed salt to the unit interval and
keep what lies below the sampling rate. A record's fate depends on nothing but
its key, so runs, partitionings, batch order and repetition cannot change it,
and new records cannot push old ones out.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hex_key

#: Fixed values of the rank: the salt and the sampling rate of the project.
SALT = "sample-v1"
RATE = Fraction(1, 25)


def rank(key: Column, salt: str = SALT) -> Column:
    """Lower-case hex SHA-256 of the salt, one NUL byte and the key. NULL stays NULL."""
    return F.sha2(F.concat(F.lit(f"{salt}\0"), key), 256)


def threshold(rate: Fraction = RATE) -> str:
    """``floor(2**256 * rate)`` as 64 hex digits; a rank below it belongs to the sample."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    if rate == 1:
        return "g"  # above every hex digit: everything is kept
    return format(2**256 * rate.numerator // rate.denominator, "064x")


def stable_sample(candidates: DataFrame, rate: Fraction = RATE, salt: str = SALT) -> DataFrame:
    """One row for each document of the sample.

    Input: ``doc_id`` and optionally ``rank_hash``, ``batch_no``, ``seen_at``;
    other columns are ignored. Result: ``doc_id`` (bare), ``rank_hash`` (the
    right one), ``first_batch``, ``first_seen``, ``deliveries``,
    ``wrong_ranks`` (deliveries whose rank was missing or wrong).

    * NULL doc_id, or one without letters and digits: no row.
    * Repeated documents: one row, whatever their other values.
    * NULL batch or time stamp: ignored by the minimum, NULL if there is none.
    * Empty input: empty result.

    The rate is applied before anything is shuffled, so only the sample moves.
    """
    have = set(candidates.columns)
    key = hex_key("doc_id")
    given = hex_key("rank_hash") if "rank_hash" in have else F.lit(None).cast("string")
    rows = candidates.select(
        key.alias("doc_id"),
        rank(key, salt).alias("rank_hash"),
        given.alias("__given"),
        (F.col("batch_no") if "batch_no" in have else F.lit(None).cast("int")).alias("__batch"),
        (F.col("seen_at") if "seen_at" in have else F.lit(None).cast("timestamp")).alias("__seen"),
    ).where((F.col("doc_id") != "") & (F.col("rank_hash") < threshold(rate)))
    return rows.groupBy("doc_id", "rank_hash").agg(
        F.min("__batch").alias("first_batch"),
        F.min("__seen").alias("first_seen"),
        F.count(F.lit(1)).alias("deliveries"),
        F.count_if(~F.col("__given").eqNullSafe(F.col("rank_hash"))).alias("wrong_ranks"),
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every doc_id of the sample."""
    return stable_sample(spark.read.parquet(f"{sf_dir}/candidate.parquet")).select("doc_id")


def p2_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample with its ranks and delivery counts."""
    return stable_sample(spark.read.parquet(f"{sf_dir}/candidate.parquet"))


QUERIES = {"p2_found": p2_found, "p2_sample": p2_sample}

_RANKED = f"""
WITH bare AS (
    SELECT lower(regexp_replace(doc_id, '[^0-9A-Za-z]+', '', 'g')) AS doc_id,
           lower(regexp_replace(rank_hash, '[^0-9A-Za-z]+', '', 'g')) AS given, batch_no, seen_at
    FROM candidate),
ranked AS (
    SELECT *, sha256('{SALT}' || chr(0) || doc_id) AS rank_hash FROM bare WHERE doc_id <> '')
"""
SQL = {
    "p2_found": _RANKED + f"SELECT DISTINCT doc_id FROM ranked WHERE rank_hash < '{threshold()}'",
    "p2_sample": _RANKED
    + f"""SELECT doc_id, rank_hash, min(batch_no) AS first_batch, min(seen_at) AS first_seen,
        count(*) AS deliveries, count(*) FILTER (WHERE given IS DISTINCT FROM rank_hash) AS wrong_ranks
    FROM ranked WHERE rank_hash < '{threshold()}' GROUP BY doc_id, rank_hash""",
}
