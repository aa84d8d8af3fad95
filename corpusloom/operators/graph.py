"""Graphs of string ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Workspace, spread_join


def number_vertices(edges: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Gives every vertex of ``edges(a, b)`` a whole number; the names ``(id, v)`` and the edges ``(a, b)`` in numbers.

    Rounds over numbers move a tenth of what they would move over 64-digit
    ids, and sum up without sorting. The numbers have no meaning; they are
    written down before use, so that a task run again cannot change them.
    """
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    names = ws.write(ids.select("id", F.monotonically_increasing_id().alias("v")))
    left = names.select(F.col("id").alias("a"), F.col("v").alias("x"))
    right = names.select(F.col("id").alias("b"), F.col("v").alias("y"))
    return names, ws.write(edges.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges(a, b)``; component is its smallest id.

    Two alternating steps keep the graph small: every vertex ties its larger
    neighbours to the smallest one it knows, then its smaller ones. Both keep
    the components and end in stars, in about log2 n rounds. Edges are rows, and
    meet one row a vertex, so adaptive execution splits what a vertex of very
    high degree has.

    NULL ends and loops tie nothing; a vertex that has only those is left out.
    """
    ws = Workspace(edges.sparkSession)
    clean = ws.write(edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())
    names, pairs = number_vertices(clean, ws)
    ws.drop(clean)
    for _ in range(max_rounds):
        large = ws.write(_tie(pairs, True))
        small = ws.write(_tie(large, False))
        before = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        changed = small.count() != before.count() or not small.join(before, ["a", "b"], "left_anti").isEmpty()
        ws.drop(pairs, large)
        pairs = small
        if not changed:
            break
    else:
        raise RuntimeError(f"not stable after {max_rounds} rounds")
    root = pairs.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("root"))
    named = names.join(root, "v", "left").select("id", F.coalesce("root", "v").alias("root"))
    first = named.groupBy("root").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("__rows"))
    return spread_join(named, first, ["root"], "id", size="__rows").select("id", "component")


def _tie(pairs: DataFrame, larger: bool) -> DataFrame:
    """One step: for every vertex v, ties its larger (or its smaller) neighbours to its smallest one; edges (a < b)."""
    both = pairs.select(F.col("a").alias("v"), F.col("b").alias("n")).union(pairs.select("b", "a"))
    least = both.groupBy("v").agg(F.min("n").alias("n")).select("v", F.least("v", "n").alias("m"))
    joined = both.join(least, "v")
    if larger:
        tied = joined.where(F.col("n") > F.col("v")).select("m", F.col("n").alias("x"))
    else:
        tied = joined.where(F.col("n") <= F.col("v")).select("m", F.col("n").alias("x")).union(least.select("m", F.col("v").alias("x")))
    return tied.where(F.col("m") != F.col("x")).select(F.least("m", "x").alias("a"), F.greatest("m", "x").alias("b")).distinct()
