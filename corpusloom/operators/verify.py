"""Checks that recompute results; each gives ``(check, n)`` rows for what is wrong and none if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hex_key
from .exact_dedup import Ownership, resolve
from .relate import differences
from .sampling import greedy_fit, split_groups


def failures(checks: dict[str, DataFrame]) -> DataFrame:
    """One row for each check whose DataFrame is not empty."""
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows).where(F.col("n") > 0)


def verify_resolution(resolution: DataFrame, records: DataFrame, rule: Ownership) -> DataFrame:
    """Ownership replayed from the records; every record resolved once; owners own themselves; every cluster has one owner."""
    again = resolve(records, rule).select("record_id", "owner_id", "disposition", "ownership_rule")
    once = resolution.groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    owner = resolution.select(F.col("record_id").alias("owner_id"), F.col("disposition").alias("owner_disposition"))
    loose = resolution.join(owner, "owner_id", "left").where(~F.col("owner_disposition").eqNullSafe(F.lit("retained")))
    return failures({"differs_from_replay": differences(resolution.select(*again.columns), again), "resolved_twice": once, "owner_not_retained": loose})


def verify_splits(assigned: DataFrame, groups: DataFrame, seed: int) -> DataFrame:
    """Splits rebuilt from the groups in another order and partitioning; names in their domain; groups in one split."""
    again = split_groups(groups.orderBy(F.desc("group_id")).repartition(3), seed).select("group_id", "split")
    torn = assigned.groupBy("group_id").agg(F.count_distinct("split").alias("n")).where(F.col("n") > 1)
    return failures(
        {
            "differs_from_rebuild": differences(assigned.select("group_id", "split"), again),
            "unknown_split": assigned.where(~F.coalesce(F.col("split").isin("train", "validation", "test"), F.lit(False))),
            "group_in_two_splits": torn,
        }
    )


def verify_sample(taken: DataFrame, documents: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """A greedy sample drawn again from shuffled input; no bucket above its target."""
    again = greedy_fit(documents.repartition(3), targets, seed).select("bucket", "doc_id")
    over = taken.groupBy("bucket").agg(F.sum("words").alias("w")).join(targets, "bucket").where(F.col("w") > F.col("target_words"))
    return failures({"differs_from_rebuild": differences(taken.select("bucket", "doc_id"), again), "bucket_above_target": over})


def verify_manifest(rows: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each unit against the manifest's ``rows``: missing units, units not listed, wrong counts."""
    have = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__have"))
    both = have.join(manifest.select(*keys, F.col("rows").alias("__told")), keys, "full")
    return failures(
        {
            "unit_missing": both.where(F.col("__have").isNull()),
            "unit_not_listed": both.where(F.col("__told").isNull()),
            "rows_differ": both.where(F.col("__have") != F.col("__told")),
        }
    )


def broken_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(check, n)`` for every rule that some rows break; NULL counts as broken."""
    bad = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return bad.select(F.expr(f"stack({len(rules)}, {pairs}) AS (check, n)")).where(F.col("n") > 0)


def assignment_errors(assigned: DataFrame, groups: DataFrame) -> DataFrame:
    """``(error, rows)`` for every rule that rows of ``assigned(group_id, split, rank_hash)`` break; groups in two splits count once.

    ``groups(group_id)`` are the known ones, in bare form. Splits and ranks are
    compared in comparable form, ids are expected in it.
    """
    bare = hex_key("group_id")
    known = groups.select(F.col("group_id").alias("__g"), F.lit(True).alias("__known")).where(F.col("__g").isNotNull()).distinct()
    rows = assigned.withColumn("__g", bare).join(known, "__g", "left")
    wrong = [
        ("group_missing", F.coalesce("__g", F.lit("")) == ""),
        ("group_spelled_unevenly", F.col("group_id") != F.col("__g")),
        ("split_unknown", ~F.coalesce(F.col("split").isin("train", "validation", "test"), F.lit(False))),
        ("rank_malformed", ~F.coalesce(F.col("rank_hash").rlike("^[0-9a-f]{64}$"), F.lit(False))),
        ("group_not_in_refs", (F.col("__g") != "") & F.col("__known").isNull()),
    ]
    each = rows.select(F.explode(F.array_compact(F.array(*[F.when(bad, name) for name, bad in wrong]))).alias("error"))
    torn = rows.where(F.col("__g") != "").groupBy("__g").agg(F.count_distinct("split").alias("n")).where(F.col("n") > 1).select(F.lit("group_in_two_splits").alias("error"))
    return each.unionByName(torn).groupBy("error").agg(F.count(F.lit(1)).alias("rows"))


def pair_errors(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``(error, rows)`` for every rule that rows of ``pairs(a, b, estimated_similarity, bucket_hits, max_bucket_size, config_mask)`` break; a pair given repeatedly counts once. Ids are in bare form; NULL counts as missing."""
    known = records.select(F.col("record_id").alias("__k"), F.lit(True).alias("__known")).where(F.col("__k").isNotNull()).distinct()
    rows = pairs
    for end in "ab":
        rows = rows.join(known.withColumnsRenamed({"__k": end, "__known": f"__known_{end}"}), end, "left")
    unknown = ((F.col("a") != "") & F.col("__known_a").isNull()) | ((F.col("b") != "") & F.col("__known_b").isNull())
    s = F.col("estimated_similarity")
    wrong = [
        ("id_missing", (F.coalesce("a", F.lit("")) == "") | (F.coalesce("b", F.lit("")) == "")),
        ("record_with_itself", F.col("a") == F.col("b")),
        ("order_reversed", F.col("a") > F.col("b")),
        ("similarity_unusable", ~F.coalesce(s.between(0, 1) & ~F.isnan(s), F.lit(False))),
        ("record_unknown", unknown),
        ("evidence_impossible", (F.col("bucket_hits") < 1) | (F.col("max_bucket_size") < 2) | (F.col("config_mask") < 1)),
    ]
    each = rows.select(F.explode(F.array_compact(F.array(*[F.when(bad, name) for name, bad in wrong]))).alias("error"))
    again = pairs.groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(F.lit("pair_repeated").alias("error"))
    return each.unionByName(again).groupBy("error").agg(F.count(F.lit(1)).alias("rows"))
