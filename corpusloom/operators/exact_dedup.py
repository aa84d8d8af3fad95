"""Exact duplicates: ownership, accounting and diagnostics.

Records with one content hash form a cluster. One record owns it, by a total
order that has nothing to do with arrival; records of preserved sources never
compete and are always kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import stable_id
from ..runtime import spread_join


@dataclass(frozen=True)
class Ownership:
    """Who owns a cluster: primary sources first, then lower tiers, then names.

    Sources and subsets are given in the form in which the columns hold them.
    """

    primary: tuple[str, ...] = ()
    preserved: tuple[str, ...] = ()
    tiers: dict[str, int] = field(default_factory=dict)
    unknown_tier: int = 5

    def kind(self) -> Column:
        return F.when(F.col("source").isin(*self.primary), 0).otherwise(1) if self.primary else F.lit(1)

    def tier(self) -> Column:
        out = F.when(self.kind() == 0, 0)
        for subset, tier in sorted(self.tiers.items()):
            out = out.when(F.col("subset") == subset, tier)
        return out.otherwise(self.unknown_tier)

    def is_preserved(self) -> Column:
        return F.coalesce(F.col("source").isin(*self.preserved), F.lit(False)) if self.preserved else F.lit(False)


def resolve(records: DataFrame, rule: Ownership) -> DataFrame:
    """A row for each record: ``record_id, content_sha256, source, subset, words, cluster_id, cluster_size, owner_id, disposition, ownership_rule``.

    * cluster_size counts the competing records of the hash; a preserved record is its own owner.
    * NULL hash: no cluster (cluster_id NULL, size 0), retained as ``no_content``.
    * Ties: by record_id. Empty input: empty result.

    The owner is a minimum, so clusters are reduced before the shuffle; its way
    back to the members is a join that deals out hot and NULL hashes.
    """
    keyed = records.select(
        "record_id", "content_sha256", "source", "subset", "words",
        rule.is_preserved().alias("preserved"),
        F.struct(rule.kind().alias("kind"), rule.tier().alias("tier"), "source", "subset", "record_id").alias("claim"),
    )
    competes = ~F.col("preserved")
    owners = (
        keyed.where(F.col("content_sha256").isNotNull())
        .groupBy("content_sha256")
        .agg(F.min(F.when(competes, F.col("claim"))).alias("owner"), F.count_if(competes).alias("cluster_size"), F.count(F.lit(1)).alias("__rows"))
    )
    rows = spread_join(keyed, owners, ["content_sha256"], "record_id", "left", "__rows")
    alone = F.col("preserved") | F.col("content_sha256").isNull()
    owner = F.when(alone, F.col("record_id")).otherwise(F.col("owner.record_id"))
    why = (
        F.when(F.col("content_sha256").isNull(), "no_content")
        .when(F.col("preserved"), "preserved")
        .when(F.col("cluster_size") == 1, "singleton")
        .when(F.col("owner.kind") == 0, "primary_first")
        .otherwise("tier_order")
    )
    return rows.select(
        "record_id", "content_sha256", "source", "subset", "words",
        F.when(F.col("content_sha256").isNotNull(), stable_id("exact-cluster-v1", "content_sha256")).alias("cluster_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("cluster_size")).cast("long").alias("cluster_size"),
        owner.alias("owner_id"),
        F.when(owner == F.col("record_id"), "retained").otherwise("dropped").alias("disposition"),
        why.alias("ownership_rule"),
    )


def duplicate_edges(resolution: DataFrame) -> DataFrame:
    """``(dropped_id, owner_id, content_sha256)`` for every dropped record."""
    return resolution.where(F.col("disposition") == "dropped").select(F.col("record_id").alias("dropped_id"), "owner_id", "content_sha256")


def cluster_index(resolution: DataFrame) -> DataFrame:
    """One row a cluster, single ones too: ``content_sha256, records, duplicates, sources, source_counts, subset_counts`` (``name=count`` pairs in order; subsets with their source)."""
    rows = resolution.where(F.col("content_sha256").isNotNull()).groupBy("content_sha256", "source", "subset").agg(F.count(F.lit(1)).alias("n"))
    told = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col("k"), F.col("n").cast("string")))), ",")
    per = rows.groupBy("content_sha256", F.col("source").alias("k")).agg(F.sum("n").alias("n"))
    by_source = per.groupBy("content_sha256").agg(F.sum("n").alias("records"), (F.sum("n") - 1).alias("duplicates"), F.count(F.lit(1)).alias("sources"), told.alias("source_counts"))
    by_subset = rows.withColumn("k", F.concat_ws("/", "source", "subset")).groupBy("content_sha256", "k").agg(F.sum("n").alias("n")).groupBy("content_sha256").agg(told.alias("subset_counts"))
    return by_source.join(by_subset, "content_sha256")


def accounting(resolution: DataFrame) -> DataFrame:
    """Documents and words before and after, by source and by source and subset (``scope``), with losses as fractions rounded to 12 places."""
    kept = F.col("disposition") == "retained"
    out = resolution.groupingSets([["source"], ["source", "subset"]], "source", "subset").agg(
        F.when(F.grouping_id() == 1, "source_total").otherwise("source_subset").alias("scope"),
        F.count(F.lit(1)).alias("documents_before"),
        F.count_if(kept).alias("documents_after"),
        F.sum("words").alias("words_before"),
        F.sum(F.when(kept, F.col("words")).otherwise(0)).alias("words_after"),
    )

    def loss(unit: str) -> Column:
        before, after = F.col(f"{unit}_before"), F.col(f"{unit}_after")
        return F.round(F.when(before > 0, (before - after) / before).otherwise(0.0), 12)

    return out.withColumns({"document_loss": loss("documents"), "word_loss": loss("words")})


def group_summary(resolution: DataFrame) -> DataFrame:
    """One row: duplicate groups, dropped records, groups across sources."""
    per = resolution.where(F.col("content_sha256").isNotNull()).groupBy("content_sha256", "source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("disposition") == "dropped").alias("d"))
    group = per.groupBy("content_sha256").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.count(F.lit(1)).alias("sources"))
    return group.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum("d"), F.lit(0)).alias("dropped"), F.count_if(F.col("sources") > 1).alias("cross_source_groups")
    )


def source_pairs(records: DataFrame) -> DataFrame:
    """How many contents each pair of sources shares, and how many each source repeats within itself: ``source_a, source_b, relation, contents, records``.

    Sources of a content are few, records are not, so pairs are made of sources.
    """
    per = records.where(F.col("content_sha256").isNotNull() & F.col("source").isNotNull()).groupBy("content_sha256", "source").agg(F.count(F.lit(1)).alias("n"))
    within = per.where(F.col("n") > 1).groupBy(F.col("source").alias("source_a"), F.col("source").alias("source_b"), F.lit("within_source").alias("relation")).agg(
        F.count(F.lit(1)).alias("contents"), F.sum("n").alias("records")
    )
    a = per.select("content_sha256", F.col("source").alias("source_a"), F.col("n").alias("x"))
    b = per.select("content_sha256", F.col("source").alias("source_b"), F.col("n").alias("y"))
    across = a.join(b, "content_sha256").where(F.col("source_a") < F.col("source_b"))
    across = across.groupBy("source_a", "source_b", F.lit("cross_source").alias("relation")).agg(F.count(F.lit(1)).alias("contents"), F.sum(F.col("x") + F.col("y")).alias("records"))
    return within.unionByName(across)


def repeats_in_preserved(records: DataFrame, rule: Ownership) -> DataFrame:
    """Contents that preserved sources repeat: ``content_sha256, records, surplus``."""
    rows = records.where(rule.is_preserved() & F.col("content_sha256").isNotNull()).groupBy("content_sha256").agg(F.count(F.lit(1)).alias("records"))
    return rows.where(F.col("records") > 1).withColumn("surplus", F.col("records") - 1)


def identity_audit(records: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """One row: rows, distinct record ids, identities that several records claim, and those among them with several contents."""
    ids = records.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("record_id").alias("distinct_records"))
    claims = records.dropna(subset=list(identity)).groupBy(*identity).agg(F.count_distinct("record_id").alias("n"), F.count_distinct("content_sha256").alias("c"))
    shared = claims.agg(F.count_if(F.col("n") > 1).alias("repeated_identities"), F.count_if((F.col("n") > 1) & (F.col("c") > 1)).alias("conflicting_identities"))
    return ids.crossJoin(F.broadcast(shared))  # one row each
