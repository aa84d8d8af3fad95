"""Problem 7: evaluation texts that leak into training text.

Method: training suffix arrays. All suffixes of a shard of documents are
sorted whole; every suffix of every test text is looked up by binary search,
token after token, until nothing in the shard goes on like it. What leaves the
search at a depth matches verbatim to that depth and no further, so the search
itself gives every match, its length and its place. Documents so found are
reported, and can be removed.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import fold_key

#: Fixed values of a leak: adjacent tokens, and length and share of the runs of five.
ADJACENT, RUN, LONG_FIELD = 13, 5, 40
#: Tokens of a shard that gets a suffix array of its own.
SHARD_TOKENS = 1_500_000
#: Characters of test text of a block; a worker holds one block at a time.
BLOCK_CHARACTERS = 8_000_000

_TOKEN = re.compile(r"[^\W_]+")
_MARKS = regex.compile(r"\p{M}+")


def match_tokens(text: str) -> list[str]:
    """Longest runs of letters and digits after case folding, NFD and removal of combining marks."""
    if text.isascii():
        return _TOKEN.findall(text.lower())
    return _TOKEN.findall(_MARKS.sub("", unicodedata.normalize("NFD", text.casefold())))


class TestTexts:
    """Distinct test texts of a block as numbers, ready to be looked up in any shard."""

    __test__ = False  # not a test case

    def __init__(self, fields: list[tuple[str, str, str]]) -> None:
        """``fields``: (example_id, field_id, text)."""
        by_tokens: dict[tuple[str, ...], list[tuple[str, str]]] = defaultdict(list)
        for example, field, text in sorted(set(fields)):
            tokens = tuple(match_tokens(text))
            if len(tokens) >= min(ADJACENT, LONG_FIELD):
                by_tokens[tokens].append((example, field))
        texts = sorted(by_tokens)
        self.owners = [by_tokens[t] for t in texts]
        self.words = sorted({w for t in texts for w in t})
        number = {w: i for i, w in enumerate(self.words)}
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.tokens = np.array([number[w] for t in texts for w in t], dtype=np.int64)
        #: of each place: its text, and how many tokens of the text are left from there
        self.text = np.repeat(np.arange(len(texts)), sizes)
        ends = np.cumsum(sizes)
        self.left = (ends[self.text] - np.arange(len(self.tokens))) if texts else np.zeros(0, dtype=np.int64)
        # distinct runs of five of the long texts, each with one place that it starts at
        at = np.flatnonzero((self.left >= RUN) & (sizes[self.text] >= LONG_FIELD)) if texts else np.zeros(0, dtype=np.int64)
        stacked = np.stack([self.tokens[at + j] for j in range(RUN)], axis=1) if len(at) else np.zeros((0, RUN), dtype=np.int64)
        distinct, first, gram = np.unique(stacked, axis=0, return_index=True, return_inverse=True)
        self.gram_at = at[first] if len(at) else at
        pairs = np.unique(self.text[at] * max(1, len(distinct)) + gram.reshape(-1)) if len(at) else at
        self.gram_text, self.gram = pairs // max(1, len(distinct)), pairs % max(1, len(distinct))
        self.gram_start = np.searchsorted(self.gram_text, np.arange(len(texts) + 1))
        self.grams = np.diff(self.gram_start)


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, with the range each belongs to."""
    n = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """The places of ``ids`` in the order of their whole suffixes, by prefix doubling.

    Every document must end with a number that stands nowhere else. A round
    doubles the depth that suffixes are sorted by, and only those still equal
    to another take part in it.
    """
    n = len(ids)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(ids.max()).bit_length())
    depth = max(1, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    far = np.concatenate([ids, np.zeros(depth, dtype=np.int64)])
    for j in range(depth):
        key = (key << bits) | far[j : j + n]
    order = np.argsort(key, kind="stable")
    head = np.concatenate([[True], np.diff(key[order]) != 0])
    # a suffix's rank is the place of the first one equal to it so far
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    slots = np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(slots):
        tied = order[slots]
        key = rank[tied] * n + rank[np.minimum(tied + depth, n - 1)]
        turn = np.argsort(key, kind="stable")
        tied, key = tied[turn], key[turn]
        order[slots] = tied
        head = np.concatenate([[True], np.diff(key) != 0])
        rank[tied] = np.maximum.accumulate(np.where(head, slots, 0))
        slots = slots[~(head & np.append(head[1:], True))]
        depth *= 2
    return order


class Shard:
    """The suffix array of a few documents."""

    def __init__(self, codes: dict[str, int], ids: np.ndarray, sizes: list[int]) -> None:
        """``codes`` number the shard's words from 0; ``ids`` are the documents' tokens, each document closed by -1, ``sizes`` their numbers with that."""
        self.codes = codes
        self.closers = len(sizes)
        self.document = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(np.array(sizes, dtype=np.int64)) - 1 if sizes else np.zeros(0, dtype=np.int64)
        self.start = ends - np.array(sizes, dtype=np.int64) + 1
        self.ids = ids + len(sizes)
        self.ids[ends] = np.arange(len(sizes))  # closers differ, so no two suffixes are equal
        self.suffixes = suffix_array(self.ids)
        self.first = self.ids[self.suffixes]

    def search(self, tests: TestTexts) -> list[tuple[int, int, int, int, int, int]]:
        """``(document, text, longest, start, runs, all runs)`` for each leak; start is the place of the longest match in tokens, the first of equal ones."""
        matches, low, high = self._matches(tests)
        longest = self._longest(tests, *matches)
        runs = self._shared_runs(tests, low[tests.gram_at], high[tests.gram_at])
        out = []
        for key in sorted(longest.keys() | runs.keys()):
            length, start = longest.get(key, (0, -1))
            out.append((*key, length, start, runs.get(key, 0), int(tests.grams[key[1]])))
        return out

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, token: np.ndarray, after: bool) -> np.ndarray:
        """Binary search in many ranges of the array at once: the first slot whose token at ``depth`` is not below (or, ``after``, above) the wanted one."""
        low, high = low.copy(), high.copy()
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            going = low < high
            found = self.ids[self.suffixes[np.where(going, middle, 0)] + np.where(going, depth, 0)]
            right = going & ((found <= token) if after else (found < token))
            low = np.where(right, middle + 1, low)
            high = np.where(going & ~right, middle, high)
        return low

    def _matches(self, t: TestTexts) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
        """All matches of ``ADJACENT`` tokens or more as ``(place in the tests, from slot, to slot, length)``, and each place's range of slots that begin with its first ``RUN`` tokens."""
        code = np.array([self.codes.get(w, -1) for w in t.words], dtype=np.int64)
        code = np.where(code < 0, -1, code + self.closers)
        tokens = code[t.tokens] if len(t.tokens) else t.tokens
        run_low, run_high = np.zeros(len(tokens), dtype=np.int64), np.zeros(len(tokens), dtype=np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        at = np.flatnonzero((t.left >= RUN) & (tokens >= 0))
        low, high = np.searchsorted(self.first, tokens[at], "left"), np.searchsorted(self.first, tokens[at], "right")
        depth = 1

        def leave(which: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            some = a < b
            if depth >= ADJACENT and some.any():
                out.append((which[some], a[some], b[some], np.full(int(some.sum()), depth, dtype=np.int64)))

        while len(at):
            alive = low < high
            at, low, high = at[alive], low[alive], high[alive]
            if depth == RUN:
                run_low[at], run_high[at] = low, high
            ended = t.left[at] == depth
            leave(at[ended], low[ended], high[ended])
            at, low, high = at[~ended], low[~ended], high[~ended]
            token = tokens[at + depth]
            inner_low = self._bound(low, high, depth, token, False)
            inner_high = self._bound(inner_low, high, depth, token, True)
            leave(at, low, inner_low)
            leave(at, inner_high, high)
            low, high = inner_low, inner_high
            depth += 1
        none = np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, none, none), run_low, run_high

    def _longest(self, t: TestTexts, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """Of each document and text the longest match and its first place."""
        which, slot = _spread(low, high)
        if not len(which):
            return {}
        place, text, length = self.suffixes[slot], t.text[at[which]], length[which]
        document = self.document[place]
        order = np.lexsort((place, -length, text, document))
        place, text, length, document = place[order], text[order], length[order], document[order]
        best = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (np.diff(document) != 0)]))
        start = place[best] - self.start[document[best]]
        return {(d, x): (n, s) for d, x, n, s in zip(document[best].tolist(), text[best].tolist(), length[best].tolist(), start.tolist(), strict=True)}

    def _shared_runs(self, t: TestTexts, low: np.ndarray, high: np.ndarray) -> dict[tuple[int, int], int]:
        """Texts of which a document holds at least half of the distinct runs, whose ranges of slots are given.

        A document with half of a text's n runs holds at least one of any
        n - ceil(n / 2) + 1 of them. Those that are rarest in this shard say
        which documents come into question; all runs are counted for these.
        """
        n = high - low
        if not len(n) or not n.any():
            return {}
        order = np.lexsort((t.gram, n[t.gram], t.gram_text))  # of each text: its rarest runs first
        rank = np.arange(len(order)) - t.gram_start[t.gram_text[order]]
        size = t.grams[t.gram_text[order]]
        anchor = order[(rank < size - (size + 1) // 2 + 1) & (n[t.gram[order]] > 0)]
        which, slot = _spread(low[t.gram[anchor]], high[t.gram[anchor]])
        if not len(which):
            return {}
        texts = len(t.grams)
        asked = np.unique(self.document[self.suffixes[slot]] * texts + t.gram_text[anchor[which]])
        document, text = asked // texts, asked % texts
        # all runs of the documents in question
        gram, slot = _spread(low, high)
        owner = self.document[self.suffixes[slot]]
        concerned = np.zeros(self.closers, dtype=bool)
        concerned[document] = True
        keep = concerned[owner]
        held = np.unique(owner[keep] * len(n) + gram[keep])
        pair, entry = _spread(t.gram_start[text], t.gram_start[text + 1])
        wanted = document[pair] * len(n) + t.gram[entry]
        found = held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted
        shared = np.bincount(pair[found], minlength=len(asked))
        enough = 2 * shared >= t.grams[text]
        return {(int(d), int(x)): int(c) for d, x, c in zip(document[enough], text[enough], shared[enough], strict=True)}


COLUMNS = "example_id string, field_id string, longest int, start int, shared_runs int, all_runs int"


class _Blocks:
    """Broadcast blocks of test texts, of which a worker keeps one in memory."""

    def __init__(self, blocks: list) -> None:
        self.blocks = blocks
        self.at, self.held = -1, None

    def __getstate__(self) -> dict:
        return {"blocks": self.blocks, "at": -1, "held": None}

    def __iter__(self) -> Iterator[TestTexts]:
        for i, b in enumerate(self.blocks):
            if i != self.at:
                self.at, self.held = i, pickle.loads(b.value)
                if hasattr(b, "_value"):
                    del b._value  # the bytes; they can be read again
            yield self.held


def _scan(tests, key: str):
    """Batches of documents to batches of leaks; ``tests`` gives the blocks of test texts."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[str, int] = {}
        names, sizes, parts, total = [], [], [], 0

        def close() -> pd.DataFrame:
            shard = Shard(codes, np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), sizes)
            rows = [(names[d], e, f, *rest) for t in tests for d, x, *rest in shard.search(t) for e, f in t.owners[x]]
            return pd.DataFrame(rows, columns=[key, "example_id", "field_id", "longest", "start", "shared_runs", "all_runs"])

        for batch in batches:
            for name, text in zip(batch[key], batch["text"], strict=True):
                if not isinstance(text, str):
                    continue
                number = codes.setdefault
                ids = np.array([number(w, len(codes)) for w in match_tokens(text)] + [-1], dtype=np.int64)
                names.append(name)
                sizes.append(len(ids))
                parts.append(ids)
                total += len(ids)
                if total >= SHARD_TOKENS:
                    yield close()
                    codes, names, sizes, parts, total = {}, [], [], [], 0
        if names:
            yield close()

    return scan


def _test_blocks(used: DataFrame) -> DataFrame:
    """``(block, payload)``: the test texts in blocks of about ``BLOCK_CHARACTERS``, made ready by the executors."""
    characters = used.agg(F.sum(F.length("original_text"))).first()[0] or 0
    blocks = max(1, -(-characters // BLOCK_CHARACTERS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        texts = TestTexts([(fold_key(e), f, t) for e, f, t in zip(rows["example_id"], rows["field_id"], rows["original_text"], strict=True)])
        return pd.DataFrame({"block": [int(rows["block"].iloc[0])], "payload": [pickle.dumps(texts)]})

    return used.withColumn("block", F.pmod(F.xxhash64("example_id", "field_id"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(build, "block int, payload binary")


def usable_fields(fields: DataFrame) -> DataFrame:
    """``(example_id, field_id, original_text)`` of the matchable fields."""
    return fields.where(F.col("matchable") & F.col("original_text").isNotNull() & F.col("example_id").isNotNull()).select("example_id", "field_id", "original_text")


def find_leaks(documents: DataFrame, fields: DataFrame) -> DataFrame:
    """Documents whose text carries a test item, whole or in part.

    ``documents(doc_id, text)``, ``fields(example_id, field_id, original_text,
    matchable)``. One row for each document and matchable field that (a) share
    ``ADJACENT`` adjacent tokens, or (b) where the field has ``LONG_FIELD``
    tokens or more and at least half of its distinct runs of ``RUN`` tokens
    occur in the text. Columns: ``doc_id, example_id, field_id, longest`` (the
    longest verbatim match in tokens, 0 if it is below ``ADJACENT``), ``start``
    (its place in the document's tokens, -1 if there is none), ``shared_runs``
    (0 unless (b) holds), ``all_runs``.

    The documents are read once, without a shuffle. Each shard of them is held
    by one task in arrays of bounded size and asked for all blocks of the test
    set in turn. Blocks are broadcast one by one, each bounded by
    ``BLOCK_CHARACTERS``; the driver hands them on as bytes and a worker has one
    in memory at a time. Fields of fewer than ``ADJACENT`` tokens cannot leak
    by this definition: :func:`too_short` lists them.

    * NULL text, NULL original_text, NULL example_id or matchable not true: no row. Empty or short texts: no match.
    * Repeated documents: one row each. Items that share a text: each has its row. Empty tables: empty result.
    * Whole texts are read, however long; other columns are ignored.
    """
    context = documents.sparkSession.sparkContext
    blocks = [context.broadcast(bytes(r.payload)) for r in _test_blocks(usable_fields(fields)).toLocalIterator()]
    kind = dict(documents.dtypes)["doc_id"]
    # ids travel as strings: pandas would turn whole numbers with NULLs among them into floats
    texts = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = texts.mapInPandas(_scan(_Blocks(blocks), "doc_id"), f"doc_id string, {COLUMNS}")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def too_short(fields: DataFrame) -> DataFrame:
    """``(example_id, field_id, tokens)`` of the matchable fields that are too short for any leak to be told."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = [len(match_tokens(t)) for t in batch["original_text"]]
            yield pd.DataFrame({"example_id": [fold_key(e) for e in batch["example_id"]], "field_id": batch["field_id"], "tokens": n})

    return usable_fields(fields).mapInPandas(count, "example_id string, field_id string, tokens long").where(F.col("tokens") < min(ADJACENT, LONG_FIELD))


def without_leaks(documents: DataFrame, leaks: DataFrame) -> DataFrame:
    """``documents`` without those that ``leaks`` names; all columns stay as they are. A NULL doc_id is never removed."""
    return documents.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark_field.parquet")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items that leaked into them."""
    return find_leaks(*_tables(spark, sf_dir)).select("doc_id", "example_id").distinct()


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak with its field, longest match and place."""
    return find_leaks(*_tables(spark, sf_dir))


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each source after removal."""
    documents, fields = _tables(spark, sf_dir)
    kept = without_leaks(documents.select("doc_id", "source"), find_leaks(documents, fields))
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))


QUERIES = {"p7_found": p7_found, "p7_leaks": p7_leaks, "p7_clean": p7_clean}


def _tokens_sql(column: str) -> str:
    return rf"regexp_extract_all(replace(lower(strip_accents({column})), 'ß', 'ss'), '[\p{{L}}\p{{N}}]+')"


def _runs_sql(n: int) -> str:
    return f"unnest(range(1, len(t) - {n} + 2)) AS p"


# every run of every document is written out; no arrays, no search
_LEAKS = f"""
WITH doc AS (SELECT doc_id, {_tokens_sql("text")} AS t FROM documents WHERE text IS NOT NULL),
field AS (SELECT lower(regexp_replace(example_id, '[^0-9A-Za-z]+', '', 'g')) AS example_id, field_id, {_tokens_sql("original_text")} AS t FROM benchmark_field WHERE matchable),
d13 AS (SELECT doc_id, p, array_to_string(t[p:p + 12], ' ') AS w FROM (SELECT *, {_runs_sql(13)} FROM doc)),
f13 AS (SELECT example_id, field_id, p AS q, array_to_string(t[p:p + 12], ' ') AS w FROM (SELECT *, {_runs_sql(13)} FROM field)),
hit AS (SELECT *, p - q AS o FROM d13 JOIN f13 USING (w)),
island AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, field_id, o ORDER BY p) AS i FROM hit),
long AS (SELECT doc_id, example_id, field_id, count(*) + 12 AS n, min(p) - 1 AS s FROM island GROUP BY doc_id, example_id, field_id, o, i),
longest AS (SELECT doc_id, example_id, field_id, max(n) AS longest, arg_min(s, (-n, s)) AS start FROM long GROUP BY ALL),
f5 AS (SELECT DISTINCT example_id, field_id, array_to_string(t[p:p + 4], ' ') AS w FROM (SELECT *, {_runs_sql(5)} FROM field WHERE len(t) >= 40)),
size AS (SELECT field_id, count(*) AS all_runs FROM f5 GROUP BY field_id),
d5 AS (SELECT DISTINCT doc_id, array_to_string(t[p:p + 4], ' ') AS w FROM (SELECT *, {_runs_sql(5)} FROM doc)),
share AS (SELECT doc_id, example_id, field_id, count(*) AS shared FROM d5 JOIN f5 USING (w) GROUP BY ALL),
half AS (SELECT share.* FROM share JOIN size USING (field_id) WHERE 2 * shared >= all_runs),
leak AS (
    SELECT doc_id, example_id, field_id, coalesce(longest, 0)::INTEGER AS longest, coalesce(start, -1)::INTEGER AS start, coalesce(shared, 0)::INTEGER AS shared_runs, coalesce(all_runs, 0)::INTEGER AS all_runs
    FROM (longest FULL JOIN half USING (doc_id, example_id, field_id)) LEFT JOIN size USING (field_id))
"""
SQL = {
    "p7_found": _LEAKS + "SELECT DISTINCT doc_id, example_id FROM leak",
    "p7_leaks": _LEAKS + "SELECT * FROM leak",
    "p7_clean": _LEAKS + "SELECT source, count(*) AS documents FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM leak) GROUP BY source",
}
