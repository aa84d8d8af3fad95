"""Structured Streaming: documents as they come, each handled once whatever fails.

Progress lies in Spark's checkpoint; sinks take a batch by its number, so a
batch that is run again after a restart replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import content_hash
from ..operators.packing import PackingPolicy


def first_deliveries(stream: DataFrame, stamp: str, delay: str) -> DataFrame:
    """Documents whose normalized text was not delivered before within ``delay``; blank ones are left out."""
    rows = stream.withColumn("content_sha256", content_hash("text")).where(F.col("content_sha256").isNotNull())
    return rows.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(["content_sha256"])


def words_by_hour(stream: DataFrame, stamp: str, delay: str, by: str) -> DataFrame:
    """Documents and words by hour; rows later than ``delay`` are left out."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0))
    return stream.withWatermark(stamp, delay).groupBy(F.window(stamp, "1 hour"), by).agg(F.count(F.lit(1)).alias("documents"), F.sum(words).alias("words"))


def write_batches(stream: DataFrame, path: str, checkpoint: str, make: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Writes each batch, after ``make``, into a folder of its number under ``path``; a batch that comes again replaces its folder.

    Runs until what is there is read, then ends; a later call goes on behind it.
    """

    def put(batch: DataFrame, number: int) -> None:
        (make(batch) if make else batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def packed_stream(stream: DataFrame, policy: PackingPolicy) -> DataFrame:
    """Full windows of a growing stream ``(split, place, token_ids)``: ``split, window, input_ids, labels``.

    Each split carries its open window as state, less than context + 1 tokens;
    within a batch documents go by ``place``. The open window itself comes out
    when later documents fill it. Where all documents are at hand,
    ``operators.packing.windows`` gives the same windows in parallel.
    """
    c, end = policy.context, policy.end

    def pack(key: tuple[Any, ...], batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        window, carry = state.get if state.exists else (0, [])
        carry = list(carry)
        rows = sorted(((p, list(t) if t is not None else []) for b in batches for p, t in zip(b["place"], b["token_ids"], strict=True)), key=lambda r: r[0])
        out = []
        if not state.exists and policy.begin is not None:
            carry.append(policy.begin)
        for _, tokens in rows:
            carry += [*map(int, tokens), end]
            while len(carry) > c:
                part = carry[: c + 1]
                labels = [policy.ignore if policy.mask_end and t == end else t for t in part[1:]]
                out.append((key[0], window, part[:-1], labels))
                window, carry = window + 1, carry[c:]
        state.update((window, carry))
        yield pd.DataFrame(out, columns=["split", "window", "input_ids", "labels"])

    return stream.groupBy("split").applyInPandasWithState(
        pack, "split string, window long, input_ids array<int>, labels array<int>", "window long, carry array<int>", "append", GroupStateTimeout.NoTimeout
    )
