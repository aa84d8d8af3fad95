"""Problem 8: mixing sources to target weights.

Method: Pfair scheduling. Each source's stream of tokens is cut into blocks;
block j of a source of weight w has release floor(j / w) and deadline
ceil((j + 1) / w); earliest deadline first over the released blocks interleaves
the sources with less than one block of deviation. When a source has nothing
left, the others go on with their weights, again to less than one block.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import fold_key, label_key
from ..runtime import Workspace, prefix_sums
from .tokenizer import public_tokens, white_space_tokens

#: Most rows of a plan; it is read by the driver, which makes one period of the schedule for each component that runs out.
PLAN_ROWS = 500
#: Tokens of a block of the schedule.
BLOCK_TOKENS = 2048
ORDER_SALT = "mix-v1"


def earliest_deadlines(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """One period of the schedule: ``(source, block, slot)``, a row for each of the sum of the weights' slots.

    Weights are whole numbers; after as many slots as their sum everything
    repeats, so this table is all a schedule of any length needs. Equal
    deadlines: by name. Sources of weight 0 get no slot.
    """
    period = sum(weights.values())
    waiting = sorted((0, name, 0) for name, w in weights.items() if w > 0)
    ready: list[tuple[int, str, int]] = []
    out = []
    heapq.heapify(waiting)
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, name, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * period // weights[name]), name, block))
        _, name, block = heapq.heappop(ready)
        out.append((name, block, slot))
        if block + 1 < weights[name]:
            heapq.heappush(waiting, ((block + 1) * period // weights[name], name, block + 1))
    return out


@dataclass(frozen=True)
class Phase:
    """A stretch of the schedule in which the same sources have blocks left: ``done`` and ``upto`` are each one's blocks before and after it."""

    first_slot: int
    slots: int
    weights: dict[str, int]
    done: dict[str, int]
    upto: dict[str, int]
    table: list[tuple[str, int, int]]

    @property
    def period(self) -> int:
        return sum(self.weights.values())


def phases(weights: dict[str, int], blocks: dict[str, int]) -> list[Phase]:
    """The schedule of ``blocks`` of each source in phases; one ends with the last block of any source, so there are no more than sources and no slot is empty.

    Sources of weight 0 that have blocks are an error.
    """
    if any(n > 0 and weights.get(name, 0) <= 0 for name, n in blocks.items()):
        raise ValueError("a source without weight has blocks")
    out: list[Phase] = []
    done, slot = dict.fromkeys(blocks, 0), 0
    while True:
        active = {name: weights[name] for name, n in blocks.items() if n > done[name]}
        if not active:
            return out
        period, table = sum(active.values()), earliest_deadlines(active)
        places: dict[str, list[int]] = {name: [] for name in active}
        for name, _, at in table:
            places[name].append(at)

        def slot_of(name: str, block: int) -> int:
            return block // active[name] * period + places[name][block % active[name]]

        length = min(slot_of(name, blocks[name] - done[name] - 1) + 1 for name in active)
        upto = {name: done[name] + length // period * active[name] + bisect_left(places[name], length % period) for name in active}
        out.append(Phase(slot, length, active, {name: done[name] for name in active}, upto, [row for row in table if row[2] < length]))
        done, slot = done | upto, slot + length


def read_plan(plan: DataFrame) -> list[tuple[str, str, int, int, int]]:
    """``(key, component, share_bp, max_repeats, budget)`` of each component.

    NULL or empty names are left out; NULL or negative numbers are 0, but a
    NULL max_repeats is 1. Of equal names the first by values counts. More than
    ``PLAN_ROWS`` rows, or shares above 10000 in sum, are an error.
    """
    rows = plan.select("component", "share_bp", "max_repeats", "budget_tokens").limit(PLAN_ROWS + 1).collect()
    if len(rows) > PLAN_ROWS:
        raise ValueError(f"a plan has {PLAN_ROWS} rows at most")
    out: dict[str, tuple[str, str, int, int, int]] = {}
    for r in sorted(rows, key=repr):
        key = fold_key(r.component)
        if key:
            repeats = 1 if r.max_repeats is None else max(0, r.max_repeats)
            out.setdefault(key, (key, r.component.strip(), max(0, r.share_bp or 0), repeats, max(0, r.budget_tokens or 0)))
    if sum(x[2] for x in out.values()) > 10000:
        raise ValueError("shares exceed 10000 basis points")
    return sorted(out.values())


def component_key(plan: list[tuple[str, str, int, int, int]]) -> Column:
    """A document's component in comparable form: its source, and its subset too where the plan parts the source by subsets."""
    parted = sorted({fold_key(name.split("/")[0]) for _, name, *_ in plan if "/" in name})
    source, subset = label_key("source"), label_key("subset")
    if not parted:
        return source
    return F.when(source.isin(parted), F.concat(source, F.coalesce(subset, F.lit("")))).otherwise(source)


def mix(documents: DataFrame, plan: DataFrame, tokens: Callable[[str], Column] = public_tokens, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The mix and its report.

    Mix, one row for each piece of a use of a document: ``component, doc_id,
    repeat_no`` (from 1), ``tokens`` (of the whole document), ``from_token,
    to_token`` (the piece, end exclusive), ``slot`` (of the schedule) and
    ``component_offset`` (tokens of the component before the piece); the order
    is (slot, component_offset). Documents are cut where blocks end, so a slot
    holds ``block_tokens`` tokens of one component, or its last ones. As long
    as a set of components has blocks left, each has had its weight's share of
    the slots of that phase to less than one block. Report, one row a
    component: ``component, share_bp, max_repeats, target_tokens, documents,
    document_tokens, most_tokens`` (with every document used max_repeats
    times), ``mixed_uses, mixed_tokens, mixed_share_bp, target_met``; what is
    mixed is added up from the mix.

    A component takes its documents in hash order, whole passes first, and in
    the last pass as many as reach the target; so it ends less than a document
    above its target, or with all documents used max_repeats times.

    * NULL or empty text: 0 tokens, never used. NULL source, or a source not in the plan: not used.
    * Repeated rows are documents of their own. Ties in hash order: by doc_id.
    * Empty documents: empty mix, every component reported with 0. Empty plan: both empty.
    """
    spark = documents.sparkSession
    ws = Workspace(spark)
    rules = read_plan(plan)
    table = spark.createDataFrame(
        [(k, c, s, m, s * b // 10000) for k, c, s, m, b in rules], "key string, component string, share_bp long, max_repeats long, target_tokens long"
    )
    table = F.broadcast(table)  # PLAN_ROWS at most
    sized = documents.select("doc_id", component_key(rules).alias("key"), tokens("text").alias("tokens"))
    # texts are read and counted once; what follows needs only the sizes
    sized = ws.write(sized.join(table.select("key"), "key").withColumn("rank", F.sha2(F.concat(F.lit(f"{ORDER_SALT}\0"), F.col("doc_id").cast("string")), 256)))
    totals = sized.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("document_tokens"))
    table = F.broadcast(table.join(totals, "key", "left").na.fill(0, ["documents", "document_tokens"]))  # one row a component
    placed = prefix_sums(sized.where(F.col("tokens") > 0).withColumn("id", F.col("doc_id")), ["key"], F.substring("rank", 1, 3), ["rank", "id"], {"before": F.col("tokens")})
    placed = placed.join(table, "key")
    passes = F.expr("target_tokens div document_tokens")
    uses = F.least(F.col("max_repeats"), passes + F.when(F.col("before") < F.col("target_tokens") - passes * F.col("document_tokens"), 1).otherwise(0))
    used = ws.write(placed.withColumn("uses", uses).where(F.col("uses") > 0).select("key", "component", "doc_id", "tokens", "before", "document_tokens", "uses"))
    mixed = _scheduled(used, {k: s for k, _, s, *_ in rules}, int(block_tokens))
    return mixed, _report(table, mixed)


def _scheduled(used: DataFrame, weights: dict[str, int], block_tokens: int) -> DataFrame:
    """Uses of documents cut at blocks, each piece in its slot."""
    spark = used.sparkSession
    amounts = used.groupBy("key").agg(F.sum(F.col("uses") * F.col("tokens")).alias("n")).collect()  # one row a component of the plan
    plan = phases(weights, {r.key: -(-r.n // block_tokens) for r in amounts})
    spans: dict[str, list[tuple[int, int, int, int, int, int]]] = {}
    for i, p in enumerate(plan):
        for name, w in p.weights.items():
            spans.setdefault(name, []).append((i, p.done[name], p.upto[name], w, p.period, p.first_slot))
    kind = "key string, spans array<struct<phase: long, done: long, upto: long, weight: long, period: long, first_slot: long>>"
    spans_of = F.broadcast(spark.createDataFrame(list(spans.items()), kind))  # one row a component of the plan
    slots = [(name, i, block, at) for i, p in enumerate(plan) for name, block, at in p.table]
    slots_of = F.broadcast(spark.createDataFrame(slots, "key string, __phase long, __block long, __at long"))  # a period a phase at most
    each = used.withColumn("repeat_no", F.explode(F.sequence(F.lit(1).cast("long"), "uses")))
    each = each.withColumn("__start", (F.col("repeat_no") - 1) * F.col("document_tokens") + F.col("before"))
    first, last = F.expr(f"__start div {block_tokens}L"), F.expr(f"(__start + tokens - 1) div {block_tokens}L")
    pieces = each.withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("__start"), F.col("block") * block_tokens)
    high = F.least(F.col("__start") + F.col("tokens"), (F.col("block") + 1) * block_tokens)
    pieces = pieces.withColumns({"component_offset": low, "__high": high}).join(spans_of, "key")
    pieces = pieces.withColumn("__s", F.element_at(F.filter("spans", lambda x: (x["done"] <= F.col("block")) & (F.col("block") < x["upto"])), 1)).drop("spans")
    pieces = pieces.withColumns({"__phase": F.col("__s.phase"), "__n": F.col("block") - F.col("__s.done")}).withColumn("__block", F.expr("__n % __s.weight"))
    placed = pieces.join(slots_of, ["key", "__phase", "__block"])
    return placed.select(
        "component", "doc_id", F.col("repeat_no").cast("int").alias("repeat_no"), "tokens", (F.col("component_offset") - F.col("__start")).alias("from_token"),
        (F.col("__high") - F.col("__start")).alias("to_token"), (F.col("__s.first_slot") + F.expr("__n div __s.weight") * F.col("__s.period") + F.col("__at")).alias("slot"), "component_offset",
    )


def _report(table: DataFrame, mixed: DataFrame) -> DataFrame:
    taken = mixed.groupBy("component").agg(F.count_if(F.col("from_token") == 0).alias("mixed_uses"), F.sum(F.col("to_token") - F.col("from_token")).alias("mixed_tokens"))
    rows = table.join(taken, "component", "left").na.fill(0, ["mixed_uses", "mixed_tokens"])
    whole = rows.agg(F.sum("mixed_tokens").alias("__all"))
    return rows.crossJoin(F.broadcast(whole)).select(  # one row
        "component", "share_bp", "max_repeats", "target_tokens", "documents", "document_tokens",
        (F.col("document_tokens") * F.col("max_repeats")).alias("most_tokens"), "mixed_uses", "mixed_tokens",
        F.coalesce(F.expr("mixed_tokens * 10000 div nullif(__all, 0)"), F.lit(0)).alias("mixed_share_bp"),
        (F.col("mixed_tokens") >= F.col("target_tokens")).alias("target_met"),
    )


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/mix_plan.parquet")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components that stay below their share; here a token is a piece parted by white space."""
    return mix(*_tables(spark, sf_dir), tokens=white_space_tokens)[1].where(~F.col("target_met")).select("component")


def p8_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of a document in the mix of white-space separated pieces, with its place in its component's stream."""
    pieces = mix(*_tables(spark, sf_dir), tokens=white_space_tokens)[0]
    return pieces.groupBy("component", "doc_id", "repeat_no", "tokens").agg(
        F.min("component_offset").alias("component_offset"), F.sum(F.col("to_token") - F.col("from_token")).alias("mixed_tokens")
    )


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix in tokens of the public vocabulary."""
    return mix(*_tables(spark, sf_dir))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached, in tokens of the public vocabulary."""
    return mix(*_tables(spark, sf_dir))[1]


QUERIES = {"p8_found": p8_found, "p8_uses": p8_uses, "p8_mix": p8_mix, "p8_shares": p8_shares}

_SIZED = r"""
WITH plan AS (
    SELECT *, lower(regexp_replace(nfc_normalize(component), '[^\p{L}\p{N}]+', '', 'g')) AS k, share_bp * budget_tokens // 10000 AS target FROM mix_plan),
doc AS (
    SELECT doc_id, lower(regexp_replace(nfc_normalize(source), '[^\p{L}\p{N}]+', '', 'g')) AS s,
           lower(regexp_replace(nfc_normalize(subset), '[^\p{L}\p{N}]+', '', 'g')) AS u,
           coalesce(len(regexp_extract_all(text, '[^\s\p{Z}\x{85}\x1c-\x1f]+')), 0) AS n
    FROM documents),
keyed AS (SELECT *, CASE WHEN s = 'gigaverbov2' THEN s || coalesce(u, '') ELSE s END AS k FROM doc),
size AS (SELECT k, sum(n)::BIGINT AS whole FROM keyed GROUP BY 1)
"""
SQL = {
    "p8_found": _SIZED + "SELECT component FROM plan LEFT JOIN size USING (k) WHERE coalesce(whole, 0) * max_repeats < target",
    "p8_uses": _SIZED
    + """, placed AS (
    SELECT k, doc_id, n, coalesce(sum(n) OVER (PARTITION BY k ORDER BY sha256('mix-v1' || chr(0) || doc_id::VARCHAR), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM keyed WHERE n > 0),
used AS (
    SELECT component, doc_id, n, before, whole, least(max_repeats, target // whole + CASE WHEN before < target - target // whole * whole THEN 1 ELSE 0 END) AS uses
    FROM placed JOIN plan USING (k) JOIN size USING (k)),
each AS (SELECT *, unnest(range(1, uses + 1)) AS repeat_no FROM used WHERE uses > 0)
SELECT component, doc_id, repeat_no::INTEGER AS repeat_no, n AS tokens, (repeat_no - 1) * whole + before AS component_offset, n AS mixed_tokens FROM each""",
}
