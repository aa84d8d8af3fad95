"""Problem 6: one group identifier for everything tied together by pairwise matches.

Method: hash-to-min. Each vertex sends its cluster set to the set's minimum and
that minimum to all others, until nothing changes. Cluster sets are kept as
rows (vertex, member) and never as arrays, and the rows of a vertex whose set
holds a large part of all records are dealt out over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hex_key
from ..operators.graph import number_vertices
from ..runtime import Workspace, hot_list, share_of, shares_of, spread_join

#: Fixed values of an accepted match.
LEAST_SIMILARITY, MOST_SIMILARITY = 0.8, 1.0


def accepted_links(pairs: DataFrame, records: DataFrame, least: float = LEAST_SIMILARITY, most: float = MOST_SIMILARITY) -> DataFrame:
    """The distinct links ``(a, b)``, a < b, that any row of ``pairs`` accepts.

    Ids are compared in their bare form. Left out: a record with itself, NULL
    or empty ids, ids not in ``records``, similarities NULL, NaN or outside
    ``least`` to ``most``. Either order and repeats give one link.
    """
    a, b = hex_key("id_a"), hex_key("id_b")
    links = (
        pairs.where(F.col("estimated_similarity").between(least, most) & ~F.isnan("estimated_similarity"))
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where((F.col("a") != "") & F.col("b").isNotNull() & (F.col("a") < F.col("b")))
        .distinct()
    )
    known = records.select(hex_key("record_id").alias("k")).where(F.col("k") != "").distinct()
    return links.join(known, F.col("a") == F.col("k"), "left_semi").join(known, F.col("b") == F.col("k"), "left_semi")


def hash_to_min(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(v, root)`` for every vertex of ``links(a, b)``; root is the smallest vertex tied to it.

    A round maps the sets C to C' with, for m = min C(v): every member of C(v)
    is put into C'(m), and m into C'(u) for every u in C(v). Sets contain their
    owner implicitly; rows (v, v) are not kept. Rounds run on numbers in place of
    ids, as any order of the vertices will do; the smallest id of each set is
    looked up at the end. It is done when the rows form
    stars: each vertex has either no smaller member, or exactly one and no
    larger one. That test is exact and costs one aggregate, which the next
    round reuses for its minima.

    Empty input gives an empty result. More than ``max_rounds`` rounds raise an
    error; a chain of n vertices takes about log2 n.
    """
    ws = Workspace(links.sparkSession)
    links = ws.write(links)
    names, edges = number_vertices(links, ws)
    ws.drop(links)
    sets = ws.write(edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select("b", "a")).distinct())
    ws.drop(edges)
    for _ in range(max_rounds):
        seen = ws.write(
            sets.groupBy("v").agg(
                F.min("u").alias("least"),
                F.count_if(F.col("u") < F.col("v")).alias("smaller"),
                F.count_if(F.col("u") > F.col("v")).alias("larger"),
                F.count(F.lit(1)).alias("size"),
            )
        )
        minima = seen.select("v", F.least("v", "least").alias("m"))
        unfinished = (F.col("smaller") > 1) | ((F.col("smaller") == 1) & (F.col("larger") > 0))
        hot, (left,) = hot_list(seen, "v", "size", F.count_if(unfinished))
        if not left:
            ws.drop(sets)
            named = ws.write(names.join(minima, "v").select("id", "m"))
            ws.drop(names, seen)
            roots = named.groupBy("m").agg(F.min("id").alias("root"), F.count(F.lit(1)).alias("size"))
            return spread_join(named, roots, ["m"], "id", size="size").select(F.col("id").alias("v"), "root")
        known = sets.withColumn("share", share_of("v", hot, "u")).join(minima.withColumn("share", shares_of("v", hot)), ["v", "share"])
        # the owner belongs to its own set, so it is sent and told like any other member
        members = known.select("m", "u").union(minima.select("m", F.col("v").alias("u"))).where(F.col("m") != F.col("u"))
        told = ws.write(members.select(F.col("m").alias("v"), "u").union(members.select("u", "m")).distinct())
        ws.drop(sets, seen)
        sets = told
    raise RuntimeError(f"not stable after {max_rounds} rounds")


def consolidate(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``(record_id, cluster_id)`` for every record in a linked set of two or more; cluster_id is the set's smallest record_id.

    Only ``pairs.id_a, id_b, estimated_similarity`` and ``records.record_id``
    are read. NULLs, repeats and unknown ids: see :func:`accepted_links`. No
    accepted link: empty result.
    """
    return hash_to_min(accepted_links(pairs, records)).select(F.col("v").alias("record_id"), F.col("root").alias("cluster_id"))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(spark.read.parquet(f"{sf_dir}/pairs.parquet"), spark.read.parquet(f"{sf_dir}/records.parquet"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of a linked set with its cluster."""
    return _clusters(spark, sf_dir)


def p6_cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters by size."""
    sizes = _clusters(spark, sf_dir).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("records"))
    return sizes.groupBy("records").agg(F.count(F.lit(1)).alias("clusters"))


QUERIES = {"p6_found": p6_found, "p6_cluster_sizes": p6_cluster_sizes}

_REACHED = """
WITH RECURSIVE known AS (
    SELECT DISTINCT lower(regexp_replace(record_id, '[^0-9A-Za-z]+', '', 'g')) AS k FROM records),
two AS (
    SELECT lower(regexp_replace(id_a, '[^0-9A-Za-z]+', '', 'g')) AS a, lower(regexp_replace(id_b, '[^0-9A-Za-z]+', '', 'g')) AS b
    FROM pairs WHERE estimated_similarity BETWEEN 0.8 AND 1 AND NOT isnan(estimated_similarity)),
link AS (
    SELECT DISTINCT a, b FROM two
    WHERE a <> b AND a IN (SELECT k FROM known) AND b IN (SELECT k FROM known)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(v, u) AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT reach.v, both_ways.b FROM reach JOIN both_ways ON reach.u = both_ways.a),
cluster AS (SELECT v AS record_id, min(u) AS cluster_id FROM (SELECT v, u FROM reach UNION ALL SELECT v, v FROM reach) GROUP BY v)
"""
SQL = {
    "p6_found": _REACHED + "SELECT record_id, cluster_id FROM cluster",
    "p6_cluster_sizes": _REACHED
    + """SELECT records, count(*) AS clusters FROM (
        SELECT cluster_id, count(*) AS records FROM cluster GROUP BY cluster_id) GROUP BY records""",
}
