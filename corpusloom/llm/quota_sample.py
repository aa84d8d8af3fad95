"""Problem 5: a sample that matches target category sizes.

Method: systematic unequal-probability sampling. Documents stand in random
order (by hash) within their sorted categories; inclusion probabilities are
summed up along that order across partitions; from one random start every
integer crossing selects a document; then the floors are repaired.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hex_key, label_key
from ..runtime import bounded_side, cut, prefix_sums
from .stable_sample import SALT, rank

#: Inclusion probabilities are integers of this unit, so that sums are exact in any order.
UNIT = 10**8
#: Most categories of a plan; everything with one row a category is broadcast.
PLAN_ROWS = 10_000
#: Hex digits of the rank that cut a category into cells: 4,096 cells a category.
CELL_DIGITS = 3


def current_candidates(candidates: DataFrame, plan: DataFrame) -> DataFrame:
    """The current row of each document with a plan's category.

    Of a document the row with the latest ``seen_at`` counts (ties: the larger
    batch, then the larger words and bucket; NULLs are oldest and smallest).
    Rows whose words are NULL or not positive, or whose category is NULL or
    not in the plan, are left out after that choice.
    """
    rows = candidates.select(
        hex_key("doc_id").alias("doc_id"),
        F.struct("seen_at", "batch_no", F.col("normalized_words").alias("words"), F.col("sample_bucket").alias("b")).alias("__row"),
    ).where(F.col("doc_id") != "")
    current = rows.groupBy("doc_id").agg(F.max("__row").alias("r")).where(F.col("r.words") > 0)
    keyed = current.select("doc_id", F.col("r.words").alias("words"), label_key(F.col("r.b")).alias("__bucket"))
    return keyed.join(F.broadcast(plan), "__bucket").drop("__bucket")  # PLAN_ROWS at most


def plan_rows(plan: DataFrame) -> DataFrame:
    """The plan with one row a category: the largest target and floor of equal names; NULL names are dropped, NULL sizes are 0. More than ``PLAN_ROWS`` are an error."""
    rows = (
        plan.select(
            label_key("sample_bucket").alias("__bucket"),
            F.trim("sample_bucket").alias("sample_bucket"),
            F.greatest(F.coalesce("target_words", F.lit(0)), F.lit(0)).cast("long").alias("target_words"),
            F.greatest(F.coalesce("min_words", F.lit(0)), F.lit(0)).cast("long").alias("min_words"),
        )
        .where(F.col("__bucket") != "")
        .groupBy("__bucket")
        .agg(F.min("sample_bucket").alias("sample_bucket"), F.max("target_words").alias("target_words"), F.max("min_words").alias("min_words"))
    )
    return bounded_side(rows, PLAN_ROWS, "a plan")


def random_start(seed: str) -> int:
    """The one random start of a draw, from 0 to below ``UNIT``."""
    return int(hashlib.sha256(seed.encode()).hexdigest()[:15], 16) % UNIT


def sample_to_quota(candidates: DataFrame, plan: DataFrame, seed: str = "quota-v1", salt: str = SALT) -> tuple[DataFrame, DataFrame]:
    """Draws the sample; gives the sample and the report.

    Sample: ``doc_id, sample_bucket, normalized_words, rank_hash, drawn`` —
    ``drawn`` is ``systematic`` or ``repair``. Report, one row for each
    category of the plan: ``sample_bucket, target_words, min_words,
    available_docs, available_words, sampled_docs, sampled_words,
    target_met, floor_met, share_bp`` (share of all sampled words).

    A category's need is its target or, if larger, its floor, or all it has
    when that is less. Each of its documents is drawn with probability
    need / available words; the sum of probabilities runs over all categories.
    Repair, in rank order: documents past the need are given back, and missing
    words are filled up with documents not drawn, so that every category ends
    at its need, by less than one document above it.

    * NULLs: see :func:`current_candidates` and :func:`plan_rows`.
    * Repeated documents: their current row once. Ties in rank: by doc_id.
    * Empty candidates: empty sample, every category reported with 0.
    * Empty plan: both results empty.
    """
    plan = plan_rows(plan)
    # read by the totals, both prefix sums and the repair: written once
    docs = cut(current_candidates(candidates, plan).withColumn("rank_hash", rank(F.col("doc_id"), salt)))
    cell = F.substring("rank_hash", 1, CELL_DIGITS)
    totals = docs.groupBy("sample_bucket").agg(F.count(F.lit(1)).alias("available_docs"), F.sum("words").alias("available_words"))
    need = F.least(F.greatest("target_words", "min_words"), "available_words")
    totals = totals.withColumnRenamed("sample_bucket", "__b")
    # one row a category of the plan, so the side is as small as the plan
    frame = docs.join(F.broadcast(totals), F.col("sample_bucket") == F.col("__b")).drop("__b")
    frame = frame.withColumn("need", need).withColumn(
        "pi", F.expr(f"cast(cast(need AS decimal(28,0)) * {UNIT} div available_words AS bigint)")
    )
    placed = prefix_sums(frame, ["sample_bucket"], cell, ["rank_hash", "doc_id"], {"before": F.col("pi")}, whole_order=True)
    start = random_start(seed)
    placed = placed.withColumn("hit", F.expr(f"(before + {start}L + pi) div {UNIT}L > (before + {start}L) div {UNIT}L"))
    placed = prefix_sums(
        placed,
        ["sample_bucket"],
        cell,
        ["rank_hash", "doc_id"],
        {"hit_before": F.when(F.col("hit"), F.col("words")), "rest_before": F.when(~F.col("hit"), F.col("words"))},
    )
    hits = placed.groupBy("sample_bucket").agg(F.sum(F.when(F.col("hit"), F.col("words")).otherwise(0)).alias("hit_words"))
    hits = hits.withColumnRenamed("sample_bucket", "__b")
    placed = placed.join(F.broadcast(hits), F.col("sample_bucket") == F.col("__b")).drop("__b")
    kept = F.col("hit") & (F.col("hit_before") < F.col("need"))
    added = ~F.col("hit") & (F.col("rest_before") < F.col("need") - F.col("hit_words"))
    sample = placed.where(kept | added).select(
        "doc_id", "sample_bucket", F.col("words").alias("normalized_words"), "rank_hash", F.when(F.col("hit"), "systematic").otherwise("repair").alias("drawn")
    )
    return sample, _report(plan, totals, sample)


def _report(plan: DataFrame, totals: DataFrame, sample: DataFrame) -> DataFrame:
    drawn = sample.groupBy("sample_bucket").agg(F.count(F.lit(1)).alias("sampled_docs"), F.sum("normalized_words").alias("sampled_words"))
    rows = plan.drop("__bucket").join(totals, F.col("sample_bucket") == F.col("__b"), "left").drop("__b").join(drawn, "sample_bucket", "left")
    counts = ["available_docs", "available_words", "sampled_docs", "sampled_words"]
    rows = rows.select("sample_bucket", "target_words", "min_words", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    whole = rows.agg(F.sum("sampled_words").alias("__all"))
    return rows.crossJoin(F.broadcast(whole)).select(  # one row
        *rows.columns,
        (F.col("sampled_words") >= F.col("target_words")).alias("target_met"),
        (F.col("sampled_words") >= F.col("min_words")).alias("floor_met"),
        F.when(F.col("__all") > 0, F.floor(F.col("sampled_words") * 10000 / F.col("__all"))).otherwise(0).cast("long").alias("share_bp"),
    )


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/candidate.parquet"), spark.read.parquet(f"{sf_dir}/quota_plan.parquet")


def p5_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample."""
    return sample_to_quota(*_tables(spark, sf_dir))[0]


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each category has, should have and got."""
    return sample_to_quota(*_tables(spark, sf_dir))[1]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that could not be met."""
    return p5_report(spark, sf_dir).where(~F.col("target_met")).select("sample_bucket")


QUERIES = {"p5_found": p5_found, "p5_report": p5_report, "p5_sample": p5_sample}

_CURRENT = """
WITH plan AS (
    SELECT *, lower(regexp_replace(nfc_normalize(sample_bucket), '[^\\p{L}\\p{N}]+', '', 'g')) AS k FROM quota_plan),
cur AS (
    SELECT lower(regexp_replace(doc_id, '[^0-9A-Za-z]+', '', 'g')) AS doc,
           arg_max(struct_pack(w := normalized_words, b := sample_bucket), coalesce(seen_at, TIMESTAMP '1900-01-01')) AS r
    FROM candidate GROUP BY 1),
have AS (
    SELECT lower(regexp_replace(nfc_normalize(r.b), '[^\\p{L}\\p{N}]+', '', 'g')) AS k, sum(r.w) AS words
    FROM cur WHERE r.w > 0 GROUP BY 1)
"""
_SAMPLE = _CURRENT.rstrip() + """,
cand AS (
    SELECT trim(plan.sample_bucket) AS sample_bucket, target_words, min_words, doc AS doc_id, r.w AS words, sha256('sample-v1' || chr(0) || doc) AS rank_hash
    FROM cur JOIN plan ON plan.k = lower(regexp_replace(nfc_normalize(r.b), '[^\\p{L}\\p{N}]+', '', 'g')) WHERE r.w > 0 AND doc <> ''),
total AS (SELECT *, count(*) OVER b AS available_docs, sum(words) OVER b AS available_words FROM cand WINDOW b AS (PARTITION BY sample_bucket)),
need AS (SELECT *, least(greatest(target_words, min_words), available_words) AS need, least(greatest(target_words, min_words), available_words)::HUGEINT * 100000000 // available_words AS pi FROM total),
start AS (SELECT ('0x' || substr(sha256('quota-v1'), 1, 15))::BIGINT % 100000000 AS s),
placed AS (SELECT *, coalesce(sum(pi) OVER (ORDER BY sample_bucket, rank_hash, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + s AS before FROM need, start),
hit AS (SELECT *, (before + pi) // 100000000 > before // 100000000 AS hit FROM placed),
run AS (SELECT *, coalesce(sum(CASE WHEN hit THEN words ELSE 0 END) OVER o, 0) AS hit_before, coalesce(sum(CASE WHEN hit THEN 0 ELSE words END) OVER o, 0) AS rest_before,
    sum(CASE WHEN hit THEN words ELSE 0 END) OVER (PARTITION BY sample_bucket) AS hit_words FROM hit
    WINDOW o AS (PARTITION BY sample_bucket ORDER BY rank_hash, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sample AS (SELECT doc_id, sample_bucket, words AS normalized_words, rank_hash, CASE WHEN hit THEN 'systematic' ELSE 'repair' END AS drawn FROM run
    WHERE hit AND hit_before < need OR NOT hit AND rest_before < need - hit_words)
"""
SQL = {
    "p5_sample": _SAMPLE + "SELECT * FROM sample",
    "p5_report": _SAMPLE
    + """, rows AS (
    SELECT trim(plan.sample_bucket) AS sample_bucket, plan.target_words, plan.min_words, coalesce(a.d, 0) AS available_docs, coalesce(a.w, 0)::BIGINT AS available_words,
           coalesce(b.d, 0) AS sampled_docs, coalesce(b.w, 0)::BIGINT AS sampled_words
    FROM plan LEFT JOIN (SELECT sample_bucket, count(*) AS d, sum(words) AS w FROM cand GROUP BY 1) a ON a.sample_bucket = trim(plan.sample_bucket)
    LEFT JOIN (SELECT sample_bucket, count(*) AS d, sum(normalized_words) AS w FROM sample GROUP BY 1) b ON b.sample_bucket = trim(plan.sample_bucket))
SELECT *, sampled_words >= target_words AS target_met, sampled_words >= min_words AS floor_met, (sampled_words * 10000 // sum(sampled_words) OVER ())::BIGINT AS share_bp FROM rows""",
    "p5_found": _CURRENT
    + """SELECT plan.sample_bucket FROM plan LEFT JOIN have USING (k)
    WHERE coalesce(have.words, 0) < plan.target_words"""
}
