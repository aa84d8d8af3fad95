"""Overlap of documents with benchmark items: anchors, exact fields, runs, coverage, proximity.

Texts are read once: a scan without a shuffle turns documents into numbers of
benchmark words, looks rolling hashes of runs up in the broadcast benchmark,
compares tokens wherever a hash meets, and lets only hits out. No result rests
on a hash alone, and tokens of documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_match, match_tokens, raw_match_tokens
from ..runtime import Workspace

#: Most characters of all fields of a benchmark, which is broadcast; a larger one is an error and must be given in parts.
BENCHMARK_CHARACTERS = 50_000_000
#: Tokens of documents that are looked up at once.
CHUNK = 2_000_000


@dataclass(frozen=True)
class OverlapPolicy:
    """Sizes and thresholds; the defaults are the fixed values of the method."""

    anchor: int = 13
    seed: int = 8
    run: int = 50
    coverage: float = 0.8
    least_anchors: int = 2
    item_frequency: int = 2
    document_frequency: int = 100
    question_tokens: int = 6
    gap: int = 128
    anchored_roles: tuple[str, ...] = ("context", "passage", "question", "question_plus_answer")
    whole_roles: tuple[str, ...] = ("complete_item", "context", "passage", "question_plus_answer")

    def __post_init__(self) -> None:
        if min(self.anchor, self.seed, self.run, self.least_anchors, self.question_tokens) < 1 or not 0 < self.coverage <= 1 or self.gap < 0:
            raise ValueError("sizes must be positive and coverage lie above 0 and up to 1")


def tokenized(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """The kept columns with ``tokens``; NULL and empty texts have none."""
    return df.select(*keep, match_tokens(F.col(text)).alias("tokens"))


def question_answers(fields: DataFrame) -> DataFrame:
    """``fields`` with one more role: an item's question and correct answer in one text; items that bring the role keep their own."""
    q = fields.where(F.col("field_role") == "question").select("benchmark_name", "example_id", F.col("original_text").alias("q"))
    a = fields.where(F.col("field_role") == "correct_answer").select("example_id", F.col("original_text").alias("a"))
    made = q.join(a, "example_id").select(
        "benchmark_name", "example_id", F.concat("example_id", F.lit(":question_plus_answer")).alias("field_id"), F.lit("question_plus_answer").alias("field_role"),
        F.concat_ws(" ", "q", "a").alias("original_text"), F.lit(True).alias("matchable"),
    )
    given = fields.where(F.col("field_role") == "question_plus_answer").select("example_id")
    return fields.select(*made.columns).unionByName(made.join(given, "example_id", "left_anti"))


def with_runs(df: DataFrame, n: int, *keep: str) -> DataFrame:
    """The kept columns with ``position, hash`` of every run of n tokens; texts with fewer have no row.

    Tokens are hashed once and shifted copies of the hashes are zipped, so no
    run is spelled out. Runs are unfolded with explode_outer: with explode a
    filter for empty arrays is inferred and moved below, and all are made twice.
    """
    hashed = df.select(*keep, F.transform("tokens", lambda w: F.xxhash64(w)).alias("__h"))
    count = F.greatest(F.size("__h") - (n - 1), F.lit(0))
    places = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    zipped = F.arrays_zip(places.alias("position"), *[F.slice("__h", k + 1, count).alias(f"w{k}") for k in range(n)])
    made = F.transform(zipped, lambda x: F.struct(x["position"].alias("position"), F.xxhash64(*[x[f"w{k}"] for k in range(n)]).alias("hash")))
    unfolded = hashed.select(*keep, F.explode_outer(made).alias("__r")).where(F.col("__r").isNotNull())
    return unfolded.select(*keep, "__r.position", "__r.hash")


def anchors(fields: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """``(field_id, example_id, position, hash, words)`` of every anchor of the anchored roles; ``fields`` hold tokens."""
    used = fields.where(F.col("field_role").isin(*policy.anchored_roles))
    made = with_runs(used, policy.anchor, "field_id", "example_id", "tokens")
    return made.select("field_id", "example_id", "position", "hash", F.slice("tokens", F.col("position") + 1, policy.anchor).alias("words"))


def anchor_frequency(anchors_: DataFrame) -> DataFrame:
    """``(words, items)``: in how many items each anchor occurs."""
    return anchors_.groupBy("words").agg(F.count_distinct("example_id").alias("items"))


class Benchmark:
    """Fields as numbers, ready to be met by documents: anchors of the anchored roles, the first tokens of fields looked for whole, and answers beside questions."""

    def __init__(self, fields: Sequence[tuple[str, str, str, Sequence[str]]], answers: Sequence[tuple[str, Sequence[str]]], policy: OverlapPolicy) -> None:
        """``fields``: (field_id, example_id, role, tokens); ``answers``: (example_id, tokens)."""
        self.fields = sorted((f, e, r, tuple(t)) for f, e, r, t in fields if len(t))
        told = defaultdict(list)
        for e, t in sorted((e, tuple(t)) for e, t in answers if len(t)):
            told[e].append(t)
        words = sorted({w for *_, t in self.fields for w in t} | {w for ts in told.values() for t in ts for w in t})
        self.words = {w: i + 1 for i, w in enumerate(words)}
        self.ids = [np.array([self.words[w] for w in t], dtype=np.int64) for *_, t in self.fields]
        self.answers = {e: [np.array([self.words[w] for w in t], dtype=np.int64) for t in ts] for e, ts in told.items()}
        self.anchor = policy.anchor
        anchored = [i for i, (_, _, r, t) in enumerate(self.fields) if r in policy.anchored_roles and len(t) >= policy.anchor]
        places = [(i, p) for i in anchored for p in range(len(self.ids[i]) - policy.anchor + 1)]
        grams = np.array([self.ids[i][p : p + policy.anchor] for i, p in places], dtype=np.int64).reshape(len(places), policy.anchor)
        self.grams, number = np.unique(grams, axis=0, return_inverse=True)
        order = np.argsort(number.reshape(-1), kind="stable")
        self.gram_field = np.array([places[k][0] for k in order], dtype=np.int64)
        self.gram_place = np.array([places[k][1] for k in order], dtype=np.int64)
        self.gram_start = np.searchsorted(number.reshape(-1)[order], np.arange(len(self.grams) + 1))
        self.gram_index = self._index(self.grams)
        #: for each length of the first tokens: the fields that have it, their first tokens, and the index
        self.heads = []
        for k in range(1, policy.seed + 1):
            own = [i for i, x in enumerate(self.ids) if min(len(x), policy.seed) == k]
            if own:
                rows = np.array([self.ids[i][:k] for i in own], dtype=np.int64)
                self.heads.append((k, np.array(own), rows, self._index(rows)))

    @staticmethod
    def _hash(columns: Sequence[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            out = (out + c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def _index(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = self._hash(rows.T) if len(rows) else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashed, kind="stable")
        return hashed[order], order

    def _meet(self, ids: np.ndarray, follow: np.ndarray, rows: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``ids`` and the rows that stand there, token by token; ``follow`` tells how many known tokens begin at each place."""
        k = rows.shape[1]
        at = np.flatnonzero(follow >= k)
        if not len(at) or not len(rows):
            return at[:0], at[:0]
        hashed = self._hash([ids[at + j] for j in range(k)])
        low, high = np.searchsorted(index[0], hashed, "left"), np.searchsorted(index[0], hashed, "right")
        n = high - low
        which = np.repeat(np.arange(len(at)), n)
        row = index[1][np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]]
        place = at[which]
        same = np.ones(len(place), dtype=bool)
        for j in range(k):
            same &= ids[place + j] == rows[row, j]
        return place[same], row[same]

    def find(self, ids: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``(kind, place, field, field place, anchor)`` of anchors and of whole fields in ``ids``, in which documents are parted by 0."""
        n = len(ids)
        gap = np.flatnonzero(np.append(ids, 0) == 0)
        follow = gap[np.searchsorted(gap, np.arange(n))] - np.arange(n)
        place, gram = self._meet(ids, follow, self.grams, self.gram_index)
        count = self.gram_start[gram + 1] - self.gram_start[gram]
        which = np.repeat(np.arange(len(place)), count)
        slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.gram_start[gram[which]]
        yield "anchor", place[which], self.gram_field[slot], self.gram_place[slot], gram[which]
        for _, own, rows, index in self.heads:
            place, row = self._meet(ids, follow, rows, index)
            field = own[row]
            keep = np.array([follow[p] >= len(self.ids[f]) and np.array_equal(ids[p : p + len(self.ids[f])], self.ids[f]) for p, f in zip(place.tolist(), field.tolist(), strict=True)], dtype=bool)
            none = np.zeros(int(keep.sum()), dtype=np.int64)
            yield "whole", place[keep], field[keep], none, none - 1


def benchmark(fields: DataFrame, answers: DataFrame, policy: OverlapPolicy) -> Benchmark:
    """The benchmark of ``fields(field_id, example_id, field_role, tokens)`` and ``answers(example_id, tokens)``, on the driver and of bounded size."""
    size = fields.select("tokens").union(answers.select("tokens")).agg(F.sum(F.length(F.array_join("tokens", " ")))).first()[0] or 0
    if size > BENCHMARK_CHARACTERS:
        raise ValueError(f"a benchmark may hold {BENCHMARK_CHARACTERS} characters at most")
    told = fields.select("field_id", "example_id", "field_role", "tokens").distinct().collect()
    return Benchmark([tuple(r) for r in told], [tuple(r) for r in answers.select("example_id", "tokens").distinct().collect()], policy)


FOUND = "kind string, field_id string, example_id string, field_role string, doc_position int, field_position int, size int, anchor long"


def scan(documents: DataFrame, fields: DataFrame, answers: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """Everything of the benchmark that documents hold, in one pass over ``documents(doc_id, text)``.

    One row each: ``doc_id, kind, field_id, example_id, field_role,
    doc_position, field_position, size, anchor``. Kinds: ``anchor`` wherever a
    document holds a run of ``anchor`` tokens of an anchored role, ``whole``
    wherever it holds a whole field, ``answer`` wherever it holds an answer of
    an item whose question it holds whole (field_id is NULL).

    NULL text: no row. Repeated documents: rows of their own, which fall together in what is counted by document.
    """
    kind = dict(documents.dtypes)["doc_id"]
    held = documents.sparkSession.sparkContext.broadcast(benchmark(fields, answers, policy))  # BENCHMARK_CHARACTERS at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b: Benchmark = held.value
        known: dict[str, int] = {}

        def look(names: list, parts: list[np.ndarray]) -> pd.DataFrame:
            ids = np.concatenate(parts)
            starts = np.cumsum([0, *[len(x) for x in parts[:-1]]])
            out: list[tuple] = []
            posed: set[tuple[int, str]] = set()
            for what, place, field, field_place, anchor in b.find(ids):
                doc = np.searchsorted(starts, place, "right") - 1
                for d, p, f, q, g in zip(doc.tolist(), place.tolist(), field.tolist(), field_place.tolist(), anchor.tolist(), strict=True):
                    name, example, role, _ = b.fields[f]
                    if what == "whole" and role == "question":
                        posed.add((d, example))
                    out.append((names[d], what, name, example, role, p - int(starts[d]), q, b.anchor if what == "anchor" else len(b.ids[f]), g))
            for d, example in sorted(posed):
                own = parts[d]
                for a in b.answers.get(example, ()):
                    for p in np.flatnonzero(own == a[0]).tolist():
                        if np.array_equal(own[p : p + len(a)], a):
                            out.append((names[d], "answer", None, example, "correct_answer", p, 0, len(a), -1))
            return pd.DataFrame(out, columns=["doc_id", "kind", "field_id", "example_id", "field_role", "doc_position", "field_position", "size", "anchor"])

        names, parts, total = [], [], 0
        for batch in batches:
            for name, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not isinstance(text, str):
                    continue
                codes = []
                for w in raw_match_tokens(text):
                    c = known.get(w)
                    if c is None:
                        if len(known) > 1_000_000:
                            known.clear()
                        c = known[w] = b.words.get(fold_match(w), 0)
                    codes.append(c)
                parts.append(np.array([*codes, 0], dtype=np.int64))
                names.append(name)
                total += len(codes)
                if total >= CHUNK:
                    yield look(names, parts)
                    names, parts, total = [], [], 0
        if names:
            yield look(names, parts)

    # ids travel as strings: pandas would turn whole numbers with NULLs among them into floats
    found = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, f"doc_id string, {FOUND}")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def anchor_hits(found: DataFrame) -> DataFrame:
    """``(doc_id, field_id, example_id, doc_position, field_position, hash)`` wherever a document holds an anchor; hash numbers the anchors."""
    return found.where(F.col("kind") == "anchor").select("doc_id", "field_id", "example_id", "doc_position", "field_position", F.col("anchor").alias("hash")).distinct()


def without_frequent(hits: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """Hits whose anchor lies in ``document_frequency`` documents or fewer.

    Frequency is counted over all documents first, so nothing depends on the order in which they come.
    """
    often = hits.groupBy("hash").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") > policy.document_frequency)
    return hits.join(often, "hash", "left_anti")


def exact_places(found: DataFrame) -> DataFrame:
    """``(doc_id, field_id, example_id, field_role, start, size)``: every place where a document holds a whole field token by token."""
    return found.where(F.col("kind") == "whole").select("doc_id", "field_id", "example_id", "field_role", F.col("doc_position").alias("start"), "size").distinct()


def exact_fields(places: DataFrame) -> DataFrame:
    """The first of each document's places of a field, from :func:`exact_places`."""
    return places.groupBy("doc_id", "field_id", "example_id", "field_role").agg(F.min("start").alias("start"), F.first("size").alias("size"))


def answer_places(found: DataFrame) -> DataFrame:
    """``(doc_id, example_id, start, size)``: every place of an item's answer in the documents that hold its question."""
    return found.where(F.col("kind") == "answer").select("doc_id", "example_id", F.col("doc_position").alias("start"), "size").distinct()


def runs(hits: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """Anchors that touch or overlap in both texts, merged: ``doc_id, field_id, example_id, start, field_start, size``.

    Hits of one document, field and offset form islands; hits at other offsets
    in between do not break them. A new island starts where a hit lies beyond
    the end of the one before, so missing anchors (frequent ones are taken out)
    do not cut a passage as long as its tokens are covered by others.
    """
    offset = F.col("doc_position") - F.col("field_position")
    rows = hits.select("doc_id", "field_id", "example_id", "doc_position", "field_position").distinct().withColumn("__o", offset)
    w = Window.partitionBy("doc_id", "field_id", "__o").orderBy("field_position")
    apart = F.col("field_position") - F.lag("field_position").over(w) > policy.anchor
    island = rows.withColumn("__new", F.coalesce(apart.cast("long"), F.lit(0))).withColumn("__i", F.sum("__new").over(w))
    size = F.max("field_position") - F.min("field_position") + policy.anchor
    return island.groupBy("doc_id", "field_id", "example_id", "__o", "__i").agg(F.min("doc_position").alias("start"), F.min("field_position").alias("field_start"), size.cast("long").alias("size")).drop("__o", "__i")


def best_band(hits: Sequence[tuple[int, int]], size: int, anchor: int, drift: int) -> tuple[int, int, int]:
    """Of all bands of offsets no wider than ``drift`` the one that covers most field positions, then has most anchors; the first wins.

    ``hits`` are (field position, document position). Gives covered positions,
    distinct anchors and the band's first offset. Within the band anchors must
    ascend in both texts: the longest such chain counts.
    """
    by_offset = sorted({(d - f, f, d) for f, d in hits})
    best = (0, 0, 0)
    low = 0
    for high in range(len(by_offset)):
        while by_offset[high][0] - by_offset[low][0] > drift:
            low += 1
        if high + 1 < len(by_offset) and by_offset[high + 1][0] - by_offset[low][0] <= drift:
            continue  # a wider band from the same start covers at least as much
        chain = _ascending(sorted({(f, d) for _, f, d in by_offset[low : high + 1]}))
        covered, end = 0, 0
        for f, _ in chain:
            covered += max(0, min(f + anchor, size) - max(f, end))
            end = max(end, f + anchor)
        if (covered, len(chain)) > best[:2]:
            best = (covered, len(chain), by_offset[low][0])
    return best


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest chain of pairs that ascends in both numbers, by patience sorting."""
    from bisect import bisect_left

    ordered = sorted(pairs, key=lambda p: (p[0], -p[1]))
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, (_, d) in enumerate(ordered):
        k = bisect_left(tails, d)
        before.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(d)
            at.append(i)
        else:
            tails[k], at[k] = d, i
    chain, i = [], at[-1] if at else -1
    while i >= 0:
        chain.append(ordered[i])
        i = before[i]
    return chain[::-1]


def coverage(hits: DataFrame, fields: DataFrame, distinctive: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """``(doc_id, field_id, example_id, covered, distinctive, anchors, share)`` of the best coherent alignment.

    ``distinctive(field_id, position)`` are anchors of few items; only hits on
    them count, and share is the part of the field's distinctive positions that
    the alignment covers. Hits of one document and field — bounded by the two
    texts — are aligned in one call.
    """
    rare = hits.join(distinctive.select("field_id", F.col("position").alias("field_position")), ["field_id", "field_position"], "left_semi")
    told = distinctive.groupBy("field_id").agg(F.array_sort(F.collect_list("position")).alias("places"))  # a field's own places
    sizes = fields.select("field_id", F.size("tokens").alias("size")).join(told, "field_id")
    rows = rare.groupBy("doc_id", "field_id", "example_id").agg(F.collect_list(F.struct("field_position", "doc_position")).alias("hits"))
    rows = rows.join(F.broadcast(sizes), "field_id")  # BENCHMARK_CHARACTERS at most
    kinds = dict(hits.dtypes)
    anchor, share = policy.anchor, policy.coverage

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                drift = int(-(-(1 / share - 1) * r.size // 1))
                covered, n, _ = best_band([(h["field_position"], h["doc_position"]) for h in r.hits], r.size, anchor, drift)
                whole, end = 0, 0
                for p in r.places:
                    whole += max(0, min(p + anchor, r.size) - max(p, end))
                    end = max(end, p + anchor)
                out.append((r.doc_id, r.field_id, r.example_id, covered, whole, n, round(covered / whole, 9) if whole else 0.0))
            yield pd.DataFrame(out, columns=["doc_id", "field_id", "example_id", "covered", "distinctive", "anchors", "share"])

    return rows.mapInPandas(align, f"doc_id {kinds['doc_id']}, field_id string, example_id string, covered long, distinctive long, anchors long, share double")


def distinctive_positions(anchors_: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """``(field_id, position)`` of anchors that lie in few items."""
    few = anchor_frequency(anchors_).where(F.col("items") <= policy.item_frequency)
    return anchors_.join(few, "words", "left_semi").select("field_id", "position")


def near_answers(exact: DataFrame, answers: DataFrame, policy: OverlapPolicy) -> DataFrame:
    """``(doc_id, example_id, question_start, answer_start, distance)``: an item's answer within ``gap`` tokens of its question; the first answer counts.

    ``exact`` holds all places of questions, ``answers`` all places of answers: ``doc_id, example_id, start, size``.
    """
    q = exact.select("doc_id", "example_id", F.col("start").alias("qs"), (F.col("start") + F.col("size")).alias("qe"))
    a = answers.select("doc_id", "example_id", F.col("start").alias("s"), (F.col("start") + F.col("size")).alias("e"))
    apart = F.greatest(F.lit(0), F.col("qs") - F.col("e"), F.col("s") - F.col("qe"))
    near = q.join(a, ["doc_id", "example_id"]).withColumn("distance", apart).where(F.col("distance") <= policy.gap)
    return near.groupBy("doc_id", "example_id", F.col("qs").alias("question_start")).agg(F.min(F.struct("s", "distance")).alias("m")).select(
        "doc_id", "example_id", "question_start", F.col("m.s").alias("answer_start"), F.col("m.distance").alias("distance")
    )


def hits_by_rule(documents: DataFrame, fields: DataFrame, policy: OverlapPolicy | None = None) -> DataFrame:
    """Every hit: ``doc_id, example_id, field_id, rule, start`` for texts ``documents(doc_id, text)`` and ``fields`` of the benchmark.

    Rules: ``exact_<role>`` for whole fields, ``exact_distinctive_question``
    for questions of few items and documents, ``contiguous_token_run`` and,
    where no run is long enough, ``distinctive_anchor_coverage``. A question of
    ``question_tokens`` or more with its answer within ``gap`` tokens stands
    for the field of both; start is where the first of the two begins. Nothing
    is removed from the documents: the result is a diagnosis.
    """
    p = policy or OverlapPolicy()
    ws = Workspace(documents.sparkSession)
    used = ws.write(tokenized(question_answers(fields).where("matchable"), "original_text", "field_id", "example_id", "field_role"))
    answers = tokenized(fields.where(F.col("field_role") == "correct_answer"), "original_text", "example_id")
    found = ws.write(scan(documents.select("doc_id", "text"), used, answers, p))  # hits alone; texts are read once
    places = exact_places(found).where(F.col("field_role").isin(*p.whole_roles, "question"))
    exact = exact_fields(places)
    whole = exact.where(F.col("field_role") != "question").select("doc_id", "example_id", "field_id", F.concat(F.lit("exact_"), "field_role").alias("rule"), "start")
    # sides made of fields alone are bounded as the benchmark is
    question = used.where(F.col("field_role") == "question")
    long_enough = question.where(F.size("tokens") >= p.question_tokens).select("field_id")
    posed = places.join(F.broadcast(long_enough), "field_id", "left_semi")
    near = near_answers(posed, answer_places(found), p)
    combined = used.where(F.col("field_role") == "question_plus_answer").select("example_id", "field_id")
    beside = near.join(F.broadcast(combined), "example_id").select("doc_id", "example_id", "field_id", F.lit("exact_question_plus_answer").alias("rule"), F.least("question_start", "answer_start").alias("start"))
    whole = whole.unionByName(beside).groupBy("doc_id", "example_id", "field_id", "rule").agg(F.min("start").alias("start"))
    rare = question.groupBy("tokens").agg(F.count_distinct("example_id").alias("n")).where((F.col("n") <= p.item_frequency) & (F.size("tokens") >= p.question_tokens))
    rare = question.join(rare, "tokens", "left_semi").select("field_id")
    asked = exact.where(F.col("field_role") == "question").join(F.broadcast(rare), "field_id", "left_semi")
    common = asked.groupBy("field_id").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") > p.document_frequency)
    asked = asked.join(common, "field_id", "left_anti").select("doc_id", "example_id", "field_id", F.lit("exact_distinctive_question").alias("rule"), "start")
    marks = anchors(used, p)
    hits = ws.write(without_frequent(anchor_hits(found), p))
    long = runs(hits, p).where(F.col("size") >= p.run).groupBy("doc_id", "example_id", "field_id").agg(F.min("start").alias("start"))
    share = coverage(hits, used, distinctive_positions(marks, p), p).where((F.col("share") >= p.coverage) & (F.col("anchors") >= p.least_anchors))
    share = share.join(long.select("doc_id", "field_id"), ["doc_id", "field_id"], "left_anti")
    approx = long.select("doc_id", "example_id", "field_id", F.lit("contiguous_token_run").alias("rule"), "start").unionByName(
        share.select("doc_id", "example_id", "field_id", F.lit("distinctive_anchor_coverage").alias("rule"), F.lit(-1).alias("start"))
    )
    return whole.unionByName(asked).unionByName(approx)


def preflight(documents: DataFrame, fields: DataFrame) -> DataFrame:
    """``(measure, n)`` of what a scan would read, without looking for anything: documents, those without text, repeated ids, characters; fields, matchable ones, items, those without text, characters of matchable fields."""
    repeated = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated_ids"))
    texts = documents.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("text").isNull()).alias("documents_without_text"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters"))
    used = F.coalesce("matchable", F.lit(False))
    told = fields.agg(
        F.count(F.lit(1)).alias("fields"), F.count_if(used).alias("matchable_fields"), F.count_distinct("example_id").alias("items"), F.count_if(F.col("original_text").isNull()).alias("fields_without_text"),
        F.coalesce(F.sum(F.when(used, F.length("original_text"))), F.lit(0)).alias("benchmark_characters"),
    )
    row = texts.crossJoin(F.broadcast(repeated)).crossJoin(F.broadcast(told))  # one row each
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("n")) for c in row.columns])))


def confusion(cases: DataFrame) -> DataFrame:
    """TP, FN, FP, TN of controls by split: ``cases(split, expected, predicted)``; NULL counts as false."""
    e, p = F.coalesce("expected", F.lit(False)), F.coalesce("predicted", F.lit(False))
    return cases.groupBy("split").agg(F.count_if(e & p).alias("tp"), F.count_if(e & ~p).alias("fn"), F.count_if(~e & p).alias("fp"), F.count_if(~e & ~p).alias("tn"))


def scan_accounting(documents: DataFrame, shard: str, key: str) -> DataFrame:
    """Rows of each shard and a digest of its keys that does not depend on their order: the sum of their 60-bit hashes."""
    h = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return documents.groupBy(shard).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("digest"))
