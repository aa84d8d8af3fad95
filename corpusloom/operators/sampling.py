"""Splits, samples and allocations that depend on nothing but keys and seeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import fast_hash, stable_rank, unsigned_order
from ..runtime import Workspace, bounded_side, prefix_sums
from .current import bottom_k

#: Hex digits of a rank that cut a stratum into cells (4,096), so that no task sorts a whole stratum.
CELL_DIGITS = 3
#: Most buckets of a plan; what has one row a bucket is broadcast.
PLAN_ROWS = 10_000


def numbered(df: DataFrame, strata: Sequence[str], rank: str, key: str, name: str = "place") -> DataFrame:
    """``df`` with the place (from 1) of each row in its stratum in the order of a hex rank, ties by key. Strata and rank must not be NULL."""
    out = prefix_sums(df, strata, F.substring(rank, 1, CELL_DIGITS), [rank, key], {name: F.lit(1)})
    return out.withColumn(name, F.col(name) + 1)


def held_out(groups: Column) -> Column:
    """Groups that each held-out split takes from a stratum: one in a hundred, rounded up; none from a stratum of one."""
    return F.when(groups <= 1, 0).otherwise(F.ceil(groups / 100)).cast("long")


def split_groups(groups: DataFrame, seed: int, namespace: str = "split-rank-v1") -> DataFrame:
    """``groups(group_id, source, subset)`` with ``rank_hash, place, split``.

    In each source and subset the groups stand in the order of their rank; the
    first h are test, the next h validation, the rest train, with h from
    :func:`held_out`. A stratum of two has no test split.

    NULL group_id: no row; NULL source or subset: the stratum ''. Repeated groups: once.
    """
    rows = groups.where(F.col("group_id").isNotNull()).select("group_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("source", "subset")]).dropDuplicates(["group_id"])
    rows = rows.withColumn("rank_hash", stable_rank(namespace, seed, "group_id"))
    sizes = rows.groupBy("source", "subset").agg(F.count(F.lit(1)).alias("__n"))
    placed = numbered(rows, ["source", "subset"], "rank_hash", "group_id").join(sizes, ["source", "subset"])
    h, place = held_out(F.col("__n")), F.col("place")
    test = F.when(F.col("__n") == 2, 0).otherwise(h)
    split = F.when(place <= test, "test").when(place <= test + h, "validation").otherwise("train")
    return placed.select("group_id", "source", "subset", "rank_hash", "place", split.alias("split"))


def reservoir(df: DataFrame, key: str, k: int, strata: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """The k rows of smallest xxh64 in each stratum, ties by key; the same for any order of the input."""
    rows = df.withColumn("__h", unsigned_order(fast_hash(key, seed)))
    return bottom_k(rows, strata, "__h", key, k).drop("__h")


def largest_remainder(populations: DataFrame, name: str, population: str, target: int) -> DataFrame:
    """Shares ``target`` out in proportion to populations: whole parts first, then one each by largest remainder, ties by name.

    Without any population it is shared out evenly. NULL and negative populations are 0.
    Integers throughout, so there is no rounding to disagree about.
    """
    whole = Window.partitionBy()
    rows = populations.select(F.col(name), F.greatest(F.coalesce(F.col(population), F.lit(0)), F.lit(0)).cast("decimal(38,0)").alias("__p"))
    rows = rows.withColumn("__sum", F.sum("__p").over(whole))
    rows = rows.withColumn("__p", F.when(F.col("__sum") > 0, F.col("__p")).otherwise(F.lit(1))).withColumn("__sum", F.sum("__p").over(whole))
    rows = rows.withColumn("__base", F.expr(f"cast(__p * {target} div __sum as bigint)")).withColumn("__rest", F.expr(f"cast(__p * {target} % __sum as decimal(38,0))"))
    rows = rows.withColumn("__left", F.lit(target) - F.sum("__base").over(whole))
    order = Window.orderBy(F.desc("__rest"), name)
    given = F.col("__base") + (F.row_number().over(order) <= F.col("__left")).cast("long")
    return rows.select(name, given.cast("long").alias("allocated"))


def greedy_fit(documents: DataFrame, targets: DataFrame, seed: int, namespace: str = "sample-rank-v1", max_rounds: int = 1000) -> DataFrame:
    """Fills each bucket's target with whole documents: in rank order a document is taken if it still fits, else skipped.

    ``documents(doc_id, bucket, words)``, ``targets(bucket, target_words)``;
    the taken ones come out with ``rank_hash``. The rule looks sequential, but
    everything before the first document that does not fit is taken at once:
    a round takes that prefix in all buckets by distributed prefix sums, drops
    what can never fit again and goes on behind the one that did not fit. The
    room left shrinks below that document's size each round, so rounds are few.

    More than ``PLAN_ROWS`` buckets are an error.

    NULL keys, words NULL or not positive: never taken. Repeated doc_ids: the
    smallest words once. Ties of rank: by doc_id. Empty inputs: empty result.
    """
    ws = Workspace(documents.sparkSession)
    rows = documents.where((F.col("words") > 0) & F.col("bucket").isNotNull() & F.col("doc_id").isNotNull()).groupBy("bucket", "doc_id").agg(F.min("words").cast("long").alias("words"))
    room = bounded_side(targets.groupBy("bucket").agg(F.max("target_words").cast("long").alias("room")), PLAN_ROWS, "a plan")
    open_ones = ws.write(rows.join(room, "bucket").where(F.col("words") <= F.col("room")).withColumn("rank_hash", stable_rank(namespace, seed, "doc_id")))
    taken: list[DataFrame] = []
    for _ in range(max_rounds):
        if open_ones.isEmpty():
            break
        run = prefix_sums(open_ones, ["bucket"], F.substring("rank_hash", 1, CELL_DIGITS), ["rank_hash", "doc_id"], {"before": F.col("words")})
        place = F.struct("rank_hash", "doc_id")
        fits = F.col("before") + F.col("words") <= F.col("room")
        run = ws.write(run.withColumn("fits", fits))
        stop = run.where(~F.col("fits")).groupBy("bucket").agg(F.min(place).alias("stop"))
        marked = run.join(F.broadcast(stop), "bucket", "left").withColumn("now", F.col("stop").isNull() | (place < F.col("stop")))  # one row a bucket of the plan
        taken.append(marked.where("now").select("doc_id", "bucket", "words", "rank_hash"))
        used = marked.groupBy("bucket").agg((F.max("room") - F.sum(F.when(F.col("now"), F.col("words")).otherwise(0))).alias("left"))
        rest = marked.where(~F.col("now") & (place > F.col("stop"))).join(F.broadcast(used), "bucket").where(F.col("words") <= F.col("left"))
        following = ws.write(rest.select("bucket", "doc_id", "words", F.col("left").alias("room"), "rank_hash"))
        ws.drop(open_ones)  # what was taken is still read from run
        open_ones = following
    else:
        raise RuntimeError(f"not filled after {max_rounds} rounds")
    if not taken:
        return open_ones.select("doc_id", "bucket", "words", "rank_hash")
    return reduce(DataFrame.union, taken)


def quota_report(taken: DataFrame, targets: DataFrame, tolerance_bp: int = 100) -> DataFrame:
    """Target, actual, deviation and shortfall in basis points of each bucket and of all, and whether it is within tolerance."""
    want = targets.groupBy("bucket").agg(F.max("target_words").cast("long").alias("target_words"))
    have = taken.groupBy("bucket").agg(F.sum("words").alias("actual_words"), F.count(F.lit(1)).alias("documents"))
    rows = want.join(have, "bucket", "left").na.fill(0, ["actual_words", "documents"])
    both = rows.groupingSets([["bucket"], []], "bucket").agg(
        F.when(F.grouping_id() == 1, "total").otherwise("bucket").alias("scope"),
        F.sum("target_words").alias("target_words"), F.sum("actual_words").alias("actual_words"), F.sum("documents").alias("documents"),
    )
    short = F.expr("(target_words - actual_words) * 10000 div nullif(target_words, 0)")
    return both.select("*", (F.col("actual_words") - F.col("target_words")).alias("deviation"), F.coalesce(short, F.lit(0)).alias("shortfall_bp")).withColumn(
        "status", F.when(F.abs("shortfall_bp") <= tolerance_bp, "PASS").otherwise("FAIL")
    )


def frame(groups: DataFrame, strata: Sequence[str], rank: str, key: str, words: str, least: Column) -> DataFrame:
    """Groups in rank order until their words reach ``least``; the group that crosses it belongs to the frame."""
    out = prefix_sums(groups, strata, F.substring(rank, 1, CELL_DIGITS), [rank, key], {"__before": F.col(words)})
    return out.where(F.col("__before") < least).withColumnRenamed("__before", "words_before")


def neighbours(rows: DataFrame, within: Sequence[str], order: str, key: str) -> DataFrame:
    """Each row with the one before it in the same row group: ``key_before, key``. ``within`` must bound a row group."""
    w = Window.partitionBy(*within).orderBy(order, key)
    return rows.select(*within, F.lag(key).over(w).alias(f"{key}_before"), key).where(F.col(f"{key}_before").isNotNull())


def circular_pick(df: DataFrame, key: str, pivot: str, k: int) -> DataFrame:
    """The first k keys from ``pivot`` on, going on from the smallest key after the largest."""
    return df.where(F.col(key).isNotNull()).orderBy(F.col(key) < pivot, key).limit(k)


def round_robin(df: DataFrame, stratum: str, rank: str, key: str) -> DataFrame:
    """``turn`` for an order that visits the strata in turns: by place in the stratum, then by stratum."""
    return numbered(df, [stratum], rank, key, "turn")


def stratified_pilot(df: DataFrame, stratum: str, rank: str, key: str, size: int) -> DataFrame:
    """``size`` rows: one in five from ``short``, one in ten from ``long``, the rest from ``medium``; what a stratum lacks is filled up in rank order from what is left.

    ``size`` rows a stratum are the most that any task keeps.
    """
    quota = F.when(F.col(stratum) == "short", size // 5).when(F.col(stratum) == "long", size // 10).when(F.col(stratum) == "medium", size - size // 5 - size // 10).otherwise(0)
    few = bottom_k(df.where(F.col(stratum).isNotNull()), [stratum], rank, key, size)
    w = Window.partitionBy(stratum).orderBy(rank, key)
    few = few.withColumn("__first", F.row_number().over(w) <= quota)
    return few.orderBy(~F.col("__first"), rank, key).limit(size).drop("__first")


def multi_stratum(df: DataFrame, strata: dict[str, Column], caps: dict[str, int], rank: str, key: str) -> DataFrame:
    """Union of the bottom k of every value of every stratum; each row once, with the names of the strata that took it.

    A stratum with no more rows than its cap is taken whole.
    """
    tagged = df.withColumn(
        "__s", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), e.cast("string").alias("value"), F.lit(caps[n]).alias("cap")) for n, e in strata.items()]))
    ).where(F.col("__s.value").isNotNull())
    w = Window.partitionBy("__s.name", "__s.value").orderBy(rank, key)
    taken = tagged.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= F.col("__s.cap"))
    return taken.groupBy(*df.columns).agg(F.array_sort(F.collect_set(F.concat_ws("=", "__s.name", "__s.value"))).alias("strata"))


def families(df: DataFrame, kind: str, family: Column, key: str, rank: str, modulus: int = 1, members: int = 8) -> DataFrame:
    """Rows that share a family key (a title, a URL, a host): the first members of each family of two or more.

    Of all families those whose hash falls on 0 modulo ``modulus`` are looked at.
    """
    rows = df.select(F.lit(kind).alias("kind"), family.alias("family"), F.col(key).alias("member"), F.col(rank).alias("__r")).where(F.col("family").isNotNull())
    rows = rows.where(F.pmod(F.xxhash64("family"), F.lit(modulus)) == 0)
    first = bottom_k(rows, ["kind", "family"], "__r", "member", members)
    sizes = rows.groupBy("kind", "family").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return first.join(sizes, ["kind", "family"]).select("kind", "family", "member", "size")


def evenly_spread(n: int, k: int, seed: int, name: str) -> list[int]:
    """k of n numbered pieces (files, row groups), evenly spread, each moved by -1, 0 or 1 by hash; collisions move on to the next free piece."""
    import hashlib

    if k >= n:
        return list(range(n))
    taken: set[int] = set()
    for i in range(k):
        step = int(hashlib.sha256(f"{seed}:{name}:{i}".encode()).hexdigest()[:8], 16) % 3 - 1
        at = min(n - 1, max(0, (2 * i + 1) * n // (2 * k) + step))
        while at in taken:
            at = (at + 1) % n
        taken.add(at)
    return sorted(taken)
