"""Token sequences packed into windows of a fixed size.

Documents stand in hash order, each followed by an end token; the stream is cut
into windows of ``context`` targets. Window i holds tokens i*context to
(i+1)*context inclusive: the last one is the first of the next window, so every
token but the very first is a target exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import stable_rank
from ..runtime import prefix_sums


@dataclass(frozen=True)
class PackingPolicy:
    """Fixed values of the windows; ``begin`` is put before the first document of a split where it is given."""

    context: int = 4096
    vocabulary: int = 24576
    end: int = 2
    begin: int | None = None
    ignore: int = -100
    mask_end: bool = False

    def __post_init__(self) -> None:
        tokens = [t for t in (self.end, self.begin) if t is not None]
        if self.context < 1 or any(not 0 <= t < self.vocabulary for t in tokens) or 0 <= self.ignore < self.vocabulary:
            raise ValueError("context must be positive, special tokens in the vocabulary and the ignored label outside")


def stream_offsets(documents: DataFrame, policy: PackingPolicy, seed: int | str = 0, held_out: Sequence[str] = ("validation", "test")) -> DataFrame:
    """``documents(document_id, split, n_tokens)`` with ``rank_hash, stream_start, stream_end`` (of the document with its end token).

    Held-out splits always have the same order, whatever the seed. NULL ids or
    splits: no row. NULL n_tokens: 0, an empty document that is its end token.
    """
    rows = documents.where(F.col("document_id").isNotNull() & F.col("split").isNotNull()).withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)).cast("long"))
    fixed = stable_rank("packing-order-v1", "fixed-heldout", "document_id")
    rank = F.when(F.col("split").isin(*held_out), fixed).otherwise(stable_rank("packing-order-v1", seed, "document_id"))
    rows = rows.withColumn("rank_hash", rank)
    lead = 0 if policy.begin is None else 1
    placed = prefix_sums(rows, ["split"], F.substring("rank_hash", 1, 3), ["rank_hash", "document_id"], {"stream_start": F.col("n_tokens") + 1})
    start = F.col("stream_start") + lead
    return placed.withColumn("stream_start", start).withColumn("stream_end", F.col("stream_start") + F.col("n_tokens") + 1)


def split_lengths(offsets: DataFrame) -> DataFrame:
    """``(split, length, windows)``: tokens of each split's stream, and windows by its targets."""
    return offsets.groupBy("split").agg(F.max("stream_end").alias("length"))


def window_provenance(offsets: DataFrame, policy: PackingPolicy) -> DataFrame:
    """``(split, window, document_id, from_position, to_position)``: which part of which document's span each window's targets come from; ends exclusive.

    A document knows the windows it reaches into, so no range join is needed.
    """
    c = policy.context
    first = F.expr(f"greatest(stream_start - 1, 0L) div {c}L")
    last = F.expr(f"(stream_end - 2) div {c}L")
    # targets are positions 1 to length - 1: position p belongs to window (p - 1) div context
    rows = offsets.where(F.col("stream_end") > 1).withColumn("window", F.explode(F.sequence(first, F.greatest(first, last))))
    low = F.greatest(F.col("stream_start"), F.col("window") * c + 1)
    high = F.least(F.col("stream_end"), (F.col("window") + 1) * c + 1)
    return rows.select("split", "window", "document_id", low.alias("from_position"), high.alias("to_position")).where(F.col("from_position") < F.col("to_position"))


def windows(documents: DataFrame, policy: PackingPolicy, seed: int | str = 0) -> DataFrame:
    """``(split, window, input_ids, labels, owned_targets, padding)`` for ``documents(document_id, split, token_ids)``.

    ``input_ids`` and ``labels`` have ``context`` places. Missing places of the
    last window are filled with the end token, their labels ignored; with
    ``mask_end`` labels of end tokens are ignored too. A document is cut into
    the pieces that windows need; a window gathers at most context + 1 tokens.

    Empty documents are their end token; a split without a target has no window.
    """
    p, c = policy, policy.context
    sized = documents.withColumn("n_tokens", F.coalesce(F.size("token_ids"), F.lit(0)))
    sized = sized.withColumn("n_tokens", F.greatest("n_tokens", F.lit(0)))
    placed = stream_offsets(sized.select("document_id", "split", "n_tokens", "token_ids"), p, seed)
    body = F.concat(F.coalesce(F.col("token_ids").cast("array<int>"), F.array().cast("array<int>")), F.array(F.lit(p.end)))
    spans = placed.select("split", "stream_start", "stream_end", body.alias("tokens"))
    if p.begin is not None:
        begins = placed.select("split").distinct().select("split", F.lit(0).cast("long").alias("stream_start"), F.lit(1).cast("long").alias("stream_end"), F.array(F.lit(p.begin)).alias("tokens"))
        spans = spans.unionByName(begins)
    # window w needs positions w*c to (w+1)*c, both included
    first = F.greatest(F.expr(f"(stream_start - 1) div {c}L"), F.lit(0))
    first = F.when(F.col("stream_start") == 0, F.lit(0).cast("long")).otherwise(first)
    last = F.expr(f"(stream_end - 1) div {c}L")
    pieces = spans.withColumn("window", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("stream_start"), F.col("window") * c)
    high = F.least(F.col("stream_end"), (F.col("window") + 1) * c + 1)
    pieces = pieces.withColumns({"low": low, "high": high}).where(F.col("low") < F.col("high"))
    part = F.slice("tokens", (F.col("low") - F.col("stream_start") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    made = pieces.select("split", "window", F.struct("low", part.alias("t")).alias("piece")).groupBy("split", "window").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    flat = made.select("split", "window", F.flatten(F.transform("pieces", lambda x: x["t"])).alias("slice")).where(F.size("slice") > 1)
    owned = F.size("slice") - 1
    fill = F.lit(c) - owned
    targets = F.slice("slice", F.lit(2), owned)
    labels = F.transform(targets, lambda t: F.when(t == p.end, p.ignore).otherwise(t)) if p.mask_end else targets
    return flat.select(
        "split", "window",
        F.concat(F.slice("slice", F.lit(1), owned), F.array_repeat(F.lit(p.end), fill)).alias("input_ids"),
        F.concat(labels, F.array_repeat(F.lit(p.ignore), fill)).alias("labels"),
        owned.cast("long").alias("owned_targets"), fill.cast("long").alias("padding"),
    )


def accounting(offsets: DataFrame, policy: PackingPolicy) -> DataFrame:
    """For each split: documents, payload, end tokens, stream, targets, windows, padding."""
    rows = offsets.groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("payload"), F.max("stream_end").alias("stream"))
    targets = F.greatest(F.col("stream") - 1, F.lit(0))
    rows = rows.withColumn("end_tokens", F.col("documents")).withColumn("targets", targets)
    rows = rows.withColumn("windows", F.expr(f"(targets + {policy.context - 1}L) div {policy.context}L"))
    return rows.withColumn("padding", F.col("windows") * policy.context - F.col("targets"))


def violations(documents: DataFrame, windows_: DataFrame, policy: PackingPolicy, groups: Column | None = None) -> DataFrame:
    """``(check, n)`` of everything that breaks the rules of packing; no row if nothing does."""
    twice = documents.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    checks = [("repeated_document", twice)]
    if groups is not None:
        torn = documents.groupBy(groups.alias("g")).agg(F.count_distinct("split").alias("n")).where(F.col("n") > 1)
        checks.append(("group_in_two_splits", torn))
    bad = F.exists("input_ids", lambda t: (t < 0) | (t >= policy.vocabulary)) | (F.size("input_ids") != policy.context) | (F.size("labels") != policy.context)
    checks.append(("malformed_window", windows_.where(bad)))
    checks.append(("unfilled_inner_window", windows_.join(windows_.groupBy("split").agg(F.max("window").alias("__last")), "split").where((F.col("window") < F.col("__last")) & (F.col("padding") > 0))))
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n") for name, df in checks]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.where(F.col("n") > 0)
