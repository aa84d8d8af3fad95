"""Problem 1: splits that keep related records together.

Method: frontier breadth-first components. Adjacency is kept as rows hashed by
vertex; many seeds expand at once; labels that collide are merged in a graph of
labels, which is far smaller and is treated the same way; components are put
into splits in the order of their hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hex_key, label_key
from ..operators.graph import number_vertices
from ..runtime import Workspace, cut, hot_list, prefix_sums, share_of, shares_of, spread_join

#: Default proportions in basis points, in the order in which the hash range is dealt out.
PROPORTIONS = (("test", 100), ("validation", 100), ("train", 9800))
RANK_SALT = "split-v1"
#: Pairs of two splits of one component are made in blocks of this many groups of each.
BLOCK = 256


def ties(refs: DataFrame) -> DataFrame:
    """Distinct ``(group_id, work)`` pairs; a work is a source with an original_id, both in comparable form.

    Rows with a NULL or empty group_id are left out; works whose source or
    original_id is NULL or holds no letter or digit tie nothing.
    """
    rows = refs.select(hex_key("group_id").alias("group_id"), label_key("source").alias("s"), label_key("original_id").alias("o"))
    return rows.where((F.col("group_id") != "") & (F.col("s") != "") & (F.col("o") != "")).select(
        "group_id", F.concat_ws("|", "s", "o").alias("work")
    ).distinct()


def _edges(ties_: DataFrame) -> DataFrame:
    """Each group tied to the smallest group of each of its works, so a work of k groups costs k - 1 edges."""
    first = ties_.groupBy("work").agg(F.min("group_id").alias("b"), F.count(F.lit(1)).alias("size"))
    return spread_join(ties_, first, ["work"], "group_id", size="size").where(F.col("group_id") != F.col("b")).select(F.col("group_id").alias("a"), "b").distinct()


def _order(column: str):
    """Seeds are ranked by hash; the vertex itself breaks ties."""
    return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("id"))


def frontier_components(edges: DataFrame, max_levels: int = 40, max_steps: int = 200) -> DataFrame:
    """``(v, component)`` for every vertex of ``edges(a, b)``; component is a number.

    A level: (1) seeds are the vertices that come before all their neighbours in
    hash order — each component has one at least, and every vertex has one
    within a few steps; (2) from all seeds at once the frontier moves to
    neighbours not yet labelled; a vertex that several labels reach takes the
    first in hash order; (3) edges whose ends have different labels are the
    label graph of the next level. A label graph has at most half the vertices,
    as seeds are never neighbours. It ends when no edge is left.

    Vertices are numbered first. Empty input gives an empty result.
    """
    ws = Workspace(edges.sparkSession)
    edges = ws.write(edges)
    names, numbered = number_vertices(edges, ws)
    both = numbered.select("a", "b").union(numbered.select("b", "a")).where(F.col("a") != F.col("b")).distinct()
    adjacent = ws.write(both.select(F.col("a").alias("v"), F.col("b").alias("n")))
    ws.drop(edges, numbered)
    levels: list[DataFrame] = []
    for _ in range(max_levels):
        if adjacent.isEmpty():
            break
        nearest = ws.write(adjacent.groupBy("v").agg(F.min(_order("n")).alias("best"), F.count(F.lit(1)).alias("degree")))
        hot, _ = hot_list(nearest, "v", "degree")  # their edges are dealt out over tasks
        labels = _expand(adjacent, nearest, hot, max_steps, ws)
        levels.append(labels)
        told = labels.withColumn("share", shares_of("v", hot))
        ends = adjacent.withColumn("share", share_of("v", hot, "n")).join(told, ["v", "share"]).select(F.col("label").alias("x"), F.col("n").alias("v"))
        ends = ends.withColumn("share", share_of("v", hot, "x")).join(told, ["v", "share"])
        collided = ws.write(ends.where(F.col("x") != F.col("label")).select(F.col("x").alias("v"), F.col("label").alias("n")).distinct())
        ws.drop(adjacent, nearest)
        adjacent = collided
    else:
        raise RuntimeError(f"labels left after {max_levels} levels")
    found = names.select("id", F.col("v").alias("component"))
    for labels in levels:
        up = labels.select(F.col("v").alias("component"), "label")
        # written down each level: the join reads its sides several times
        found = ws.write(spread_join(found, up, ["component"], "id", "left").select("id", F.coalesce("label", "component").alias("component")))
    return found.select(F.col("id").alias("v"), "component")


def _expand(adjacent: DataFrame, nearest: DataFrame, hot: list, max_steps: int, ws: Workspace) -> DataFrame:
    """Labels all vertices by breadth-first search from all seeds of a level; ``nearest`` has each vertex's first neighbour in hash order."""
    state = ws.write(nearest.select("v", F.when(_order("v") < F.col("best"), F.col("v")).alias("label")))
    labelled = None
    for _ in range(max_steps):
        frontier = state.where(F.col("label").isNotNull())
        open_ones = state.where(F.col("label").isNull()).select("v")
        labelled = frontier if labelled is None else labelled.union(frontier)
        if open_ones.isEmpty():
            return labelled
        # the frontier alone is expanded, so each edge is followed once in each direction
        told = frontier.withColumn("share", shares_of("v", hot))
        reached = adjacent.withColumn("share", share_of("v", hot, "n")).join(told, ["v", "share"]).select(F.col("n").alias("v"), _order("label").alias("o"))
        reached = reached.groupBy("v").agg(F.min("o").alias("o")).select("v", F.col("o.id").alias("label"))
        state = ws.write(open_ones.join(reached, "v", "left"))
    raise RuntimeError(f"vertices left after {max_steps} steps")


def related_groups(refs: DataFrame) -> DataFrame:
    """``(group_id, component)`` for every group of ``refs``; component is the smallest group_id of it."""
    tied = cut(ties(refs))
    found = frontier_components(_edges(tied))
    found = cut(found)
    names = found.groupBy("component").agg(F.min("v").alias("name"), F.count(F.lit(1)).alias("size"))
    named = spread_join(found, names, ["component"], "v", size="size").select(F.col("v").alias("group_id"), F.col("name").alias("component"))
    groups = refs.select(hex_key("group_id").alias("group_id")).where(F.col("group_id") != "").distinct()
    return groups.join(named, "group_id", "left").select("group_id", F.coalesce("component", "group_id").alias("component"))


def assign_splits(refs: DataFrame, proportions: tuple[tuple[str, int], ...] = PROPORTIONS, salt: str = RANK_SALT) -> DataFrame:
    """``(group_id, component, rank_hash, split)`` for every group of ``refs``.

    Components stand in the order of rank_hash = SHA-256 of the salt, NUL and
    the component; each takes a stretch of the line as long as its number of
    rows, and the split in which the middle of its stretch lies. So related
    groups share a split, shares are met up to half of the component at a
    boundary, and one huge component goes where most of its rows belong.

    * NULL or empty group_id: no row. NULL or empty original_id or source: ties nothing.
    * Repeated rows of refs count as delivered. Ties of rank: by component.
    * Empty refs: empty result.
    """
    if sum(bp for _, bp in proportions) != 10000:
        raise ValueError("proportions must sum up to 10000 basis points")
    member = cut(related_groups(refs))
    weights = refs.select(hex_key("group_id").alias("group_id")).where(F.col("group_id") != "").groupBy("group_id").count()
    parts = member.join(weights, "group_id").groupBy("component").agg(F.sum("count").alias("w"))
    parts = cut(parts.withColumn("rank_hash", F.sha2(F.concat(F.lit(f"{salt}\0"), F.col("component")), 256)))
    whole = parts.agg(F.sum("w").alias("__all"))
    placed = prefix_sums(parts, [], F.substring("rank_hash", 1, 4), ["rank_hash", "component"], {"before": F.col("w")})
    placed = placed.crossJoin(F.broadcast(whole))  # one row
    middle = (F.col("before") * 2 + F.col("w")).cast("decimal(38,0)") * 10000
    end, split = 0, None
    for name, bp in proportions[:-1]:
        end += bp
        here = middle < F.col("__all") * 2 * end
        split = F.when(here, name) if split is None else split.when(here, name)
    split = F.lit(proportions[-1][0]) if split is None else split.otherwise(proportions[-1][0])
    return spread_join(member, placed.select("component", "rank_hash", split.alias("split")), ["component"], "group_id").select("group_id", "component", "rank_hash", "split")


def current_splits(split_groups: DataFrame) -> DataFrame:
    """``(group_id, split)`` of the row with the latest assigned_at of each group; split is folded and may be NULL.

    NULL time stamps are oldest; among equal ones the larger split counts.
    """
    rows = split_groups.select(hex_key("group_id").alias("group_id"), F.struct("assigned_at", label_key("split").alias("split")).alias("r"))
    return rows.where(F.col("group_id") != "").groupBy("group_id").agg(F.max("r").alias("r")).select("group_id", F.nullif(F.col("r.split"), F.lit("")).alias("split"))


def torn_members(refs: DataFrame, split_groups: DataFrame) -> DataFrame:
    """``(component, group_id, split)``: the groups of every component whose current splits are not one and the same; splits that are NULL do not count.

    One row a group: what is wrong with the splits, without writing out pairs.
    """
    rows = cut(related_groups(refs).join(current_splits(split_groups).where(F.col("split").isNotNull()), "group_id"))
    torn = rows.groupBy("component").agg(F.min("split").alias("lo"), F.max("split").alias("hi"), F.count(F.lit(1)).alias("n")).where(F.col("lo") != F.col("hi"))
    return spread_join(rows, torn.select("component", "n"), ["component"], "group_id", size="n").select("component", "group_id", "split")


def torn_apart(refs: DataFrame, split_groups: DataFrame) -> DataFrame:
    """``(group_id_a, group_id_b)``, smaller first: related groups whose current splits differ and are not NULL.

    For each two splits of a component, the groups of both are dealt out over
    blocks of ``BLOCK``, and each two blocks meet in a cell of their own: no
    task holds a component, and a row is copied once for each block of the
    other split, so copies are a small part of the pairs that result.
    """
    rows = cut(torn_members(refs, split_groups))
    sizes = rows.groupBy("component", "split").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    first, second = (sizes.select("component", F.col("split").alias(f"s{k}"), F.col("blocks").alias(f"n{k}")) for k in "ab")
    cells = cut(first.join(second, "component").where(F.col("sa") < F.col("sb")))  # at most three splits a component
    own = F.xxhash64("group_id")

    def side(mine: str, other: str) -> DataFrame:
        told = rows.withColumnRenamed("split", f"s{mine}").join(cells.hint("shuffle_merge"), ["component", f"s{mine}"])
        told = told.withColumn(f"i{mine}", F.pmod(own, F.col(f"n{mine}")).cast("int")).withColumn(f"i{other}", F.explode(F.sequence(F.lit(0), F.col(f"n{other}") - 1)))
        return told.select("component", "sa", "sb", "ia", "ib", F.col("group_id").alias(f"g{mine}"))

    joined = side("a", "b").join(side("b", "a"), ["component", "sa", "sb", "ia", "ib"])
    return joined.select(F.least("ga", "gb").alias("group_id_a"), F.greatest("ga", "gb").alias("group_id_b"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related groups that lie in different splits."""
    return torn_apart(spark.read.parquet(f"{sf_dir}/refs.parquet"), spark.read.parquet(f"{sf_dir}/split_groups.parquet"))


def p1_torn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of components that lie in more than one split."""
    return torn_members(spark.read.parquet(f"{sf_dir}/refs.parquet"), spark.read.parquet(f"{sf_dir}/split_groups.parquet"))


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split for every group."""
    return assign_splits(spark.read.parquet(f"{sf_dir}/refs.parquet"))


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the splits hold: groups, components and rows of refs."""
    refs = spark.read.parquet(f"{sf_dir}/refs.parquet")
    rows = refs.select(hex_key("group_id").alias("group_id")).where(F.col("group_id") != "").groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    return assign_splits(refs).join(rows, "group_id").groupBy("split").agg(
        F.count(F.lit(1)).alias("groups"), F.count_distinct("component").alias("components"), F.sum("n").alias("refs_rows")
    )


QUERIES = {"p1_found": p1_found, "p1_torn": p1_torn, "p1_splits": p1_splits, "p1_shares": p1_shares}

_COMPONENTS = """
WITH RECURSIVE tie AS (
    SELECT DISTINCT lower(regexp_replace(group_id, '[^0-9A-Za-z]+', '', 'g')) AS g,
           lower(regexp_replace(nfc_normalize(source), '[^\\p{L}\\p{N}]+', '', 'g')) AS s,
           lower(regexp_replace(nfc_normalize(original_id), '[^\\p{L}\\p{N}]+', '', 'g')) AS o
    FROM refs WHERE original_id IS NOT NULL),
link AS (
    SELECT DISTINCT x.g AS a, y.g AS b FROM tie x JOIN tie y USING (s, o) WHERE x.g <> y.g AND s <> '' AND o <> ''),
reach(v, u) AS (
    SELECT a, b FROM link UNION SELECT reach.v, link.b FROM reach JOIN link ON reach.u = link.a)
"""
_CURRENT = _COMPONENTS + """, cur AS (
    SELECT lower(regexp_replace(group_id, '[^0-9A-Za-z]+', '', 'g')) AS g,
           arg_max(struct_pack(v := lower(regexp_replace(split, '[^0-9A-Za-z]+', '', 'g'))), assigned_at).v AS split
    FROM split_groups GROUP BY 1)"""
_SPLITS = _COMPONENTS + """, grp AS (SELECT lower(regexp_replace(group_id, '[^0-9A-Za-z]+', '', 'g')) AS g, count(*) AS n FROM refs GROUP BY 1),
comp AS (SELECT g, n, least(g, coalesce(m, g)) AS component FROM grp LEFT JOIN (SELECT v, min(u) AS m FROM reach GROUP BY v) ON v = g WHERE g <> ''),
part AS (SELECT component, sum(n) AS w, sha256('split-v1' || chr(0) || component) AS rank_hash FROM comp GROUP BY 1),
placed AS (SELECT *, 2 * coalesce(sum(w) OVER (ORDER BY rank_hash, component ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + w AS middle2, sum(w) OVER () AS whole FROM part),
split AS (SELECT g AS group_id, component, rank_hash, n, CASE WHEN middle2 * 10000 < whole * 2 * 100 THEN 'test' WHEN middle2 * 10000 < whole * 2 * 200 THEN 'validation' ELSE 'train' END AS split
    FROM comp JOIN placed USING (component))"""
SQL = {
    "p1_found": _CURRENT + """SELECT v AS group_id_a, u AS group_id_b FROM reach JOIN cur x ON x.g = v JOIN cur y ON y.g = u
    WHERE v < u AND x.split <> y.split""",
    "p1_torn": _CURRENT + """, named AS (SELECT v AS group_id, least(v, min(u)) AS component FROM reach GROUP BY v),
    held AS (SELECT component, group_id, split FROM named JOIN cur ON g = group_id WHERE split IS NOT NULL AND split <> '')
    SELECT * FROM held WHERE component IN (SELECT component FROM held GROUP BY 1 HAVING count(DISTINCT split) > 1)""",
    "p1_splits": _SPLITS + "SELECT group_id, component, rank_hash, split FROM split",
    "p1_shares": _SPLITS + "SELECT split, count(*) AS groups, count(DISTINCT component) AS components, sum(n)::BIGINT AS refs_rows FROM split GROUP BY split",
}
