"""Problem 3: near-duplicate records with small edits.

Method: b-bit MinHash. Bands of full minima give candidates; of each minimum
only the low bits are kept, packed into a few whole numbers; the similarity of
a candidate is estimated from bit counts and corrected for chance collisions.
What passes is checked exactly on the sets of word runs.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hex_key
from ..runtime import Workspace, spread_join
from .consolidate import hash_to_min

#: Classes, and words of their texts, of a block of a bucket.
BLOCK, BLOCK_WORDS = 512, 2_000_000

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Likeness:
    """What counts as alike, and the size of the signatures.

    A pair of similarity s shares a band with probability
    1 - (1 - s**rows)**bands: 0.99985 at 0.7 with the defaults. ``margin`` is
    how far below the threshold an estimate may lie and still be checked
    exactly: with 128 minima of 4 bits its standard deviation is below 0.047,
    so the default is more than four of them; with 1 every candidate is checked.
    Texts of fewer than ``least_words`` words are left out; with 0 every record
    is in a class.
    """

    words: int = 5
    least: Fraction = Fraction(4, 5)
    least_words: int = 1
    bands: int = 32
    rows: int = 4
    bits: int = 4
    margin: float = 0.2
    seed: int = 20260701

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    def coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(self.seed)
        return draw.integers(1, 2**63, self.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, self.minima, dtype=np.uint64)


#: Fixed values of the project's own statement for this problem.
RECORDS = Likeness(words=3, least=Fraction(7, 10), least_words=20)
#: For a row of every record.
EVERY = Likeness(least_words=0)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Texts to sets of hashed word runs; remembers the hashes of words."""

    def __init__(self, words: int) -> None:
        self.words = words
        self._seen: dict[str, int] = {}
        self._factors = [np.uint64(f) for f in np.random.default_rng(words).integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]

    @staticmethod
    def words_of(text: str) -> list[str]:
        return _WORD.findall(unicodedata.normalize("NFC", text).lower() if not text.isascii() else text.lower())

    def __call__(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words, and the sorted distinct hashes of all runs of adjacent words."""
        words = self.words_of(text)
        n = len(words) - self.words + 1
        if n < 1:
            return len(words), np.zeros(0, dtype=np.uint64)
        if len(self._seen) > 500_000:
            self._seen = {}
        seen = self._seen
        for w in words:
            if w not in seen:
                seen[w] = xxhash.xxh64_intdigest(w)
        hashed = np.array([seen[w] for w in words], dtype=np.uint64)
        runs = np.zeros(n, dtype=np.uint64)
        for k, f in enumerate(self._factors):
            runs = _mix(runs + hashed[k : k + n] * f)
        return len(words), np.unique(runs)


def _signatures(sets: list[np.ndarray], like: Likeness) -> np.ndarray:
    """Minima of each set under each permutation, 32 bits each; sets must not be empty."""
    a, b = like.coefficients()
    out = np.zeros((len(sets), like.minima), dtype=np.uint32)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (size == 0 or size + len(sets[last]) <= 400_000):
            size += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last])
        starts = np.concatenate([[0], np.cumsum([len(x) for x in sets[first:last]])[:-1]])
        for k in range(like.minima):
            out[first:last, k] = np.minimum.reduceat(((flat * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), starts)
        first = last
    return out


def _pack(minima: np.ndarray, like: Likeness) -> np.ndarray:
    """Low bits of the minima, packed into whole numbers of 64 bits."""
    each = 64 // like.bits
    low = minima.astype(np.uint64) & np.uint64((1 << like.bits) - 1)
    low = np.concatenate([low, np.zeros((len(low), -like.minima % each), dtype=np.uint64)], axis=1)
    packed = np.zeros((len(low), low.shape[1] // each), dtype=np.uint64)
    for j in range(each):
        packed |= low[:, j::each] << np.uint64(j * like.bits)
    return packed.view(np.int64)


def _band_keys(minima: np.ndarray, like: Likeness) -> np.ndarray:
    keys = np.zeros((len(minima), like.bands), dtype=np.uint64)
    for r in range(like.rows):
        keys = _mix(keys + minima[:, r :: like.rows].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return keys.view(np.int64)


def _plain_digest(record_id: str, text: str | None) -> str:
    """What a text without runs is classed by: its words, the text itself where it has none, the record where there is no text.

    Digests sort before those of sets, so of two rows of one time the longer text counts.
    """
    if not isinstance(text, str):
        return f"!{record_id}"
    words = Shingler.words_of(text)
    return f"%{xxhash.xxh3_128_hexdigest(' '.join(words))}" if words else f"#{xxhash.xxh3_128_hexdigest(text)}"


def fingerprints(rows: DataFrame, like: Likeness) -> DataFrame:
    """``(record_id, loaded_at, text)`` to ``record_id, loaded_at, words, digest, packed, band_keys``.

    ``digest`` identifies the set of word runs, and texts too short for a run by
    their words; it is NULL for texts of fewer than ``least_words`` words (NULL
    has none). ``packed`` and ``band_keys`` are NULL where there is no run.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(like.words)
        for batch in batches:
            found = [shingle(t) if isinstance(t, str) else (0, np.zeros(0, dtype=np.uint64)) for t in batch["text"]]
            full = [i for i, (n, s) in enumerate(found) if n >= like.least_words and len(s)]
            digest: list = [None] * len(batch)
            packed: list = [None] * len(batch)
            keys: list = [None] * len(batch)
            for i, (n, s) in enumerate(found):
                if n >= like.least_words and not len(s):
                    digest[i] = _plain_digest(batch["record_id"].iloc[i], batch["text"].iloc[i])
            if full:
                minima = _signatures([found[i][1] for i in full], like)
                for i, p, k in zip(full, _pack(minima, like), _band_keys(minima, like), strict=True):
                    digest[i] = xxhash.xxh3_128_hexdigest(found[i][1].tobytes())
                    packed[i], keys[i] = p, k
            yield pd.DataFrame({"record_id": batch["record_id"], "loaded_at": batch["loaded_at"], "words": [n for n, _ in found], "digest": digest, "packed": packed, "band_keys": keys})

    kind = dict(rows.dtypes)["loaded_at"]
    return rows.select("record_id", "loaded_at", "text").mapInPandas(run, f"record_id string, loaded_at {kind}, words int, digest string, packed array<long>, band_keys array<long>")


def estimate(a: Column, b: Column, like: Likeness) -> Column:
    """Similarity from the packed low bits: the share of equal minima, corrected for those equal by chance."""
    each = 64 // like.bits
    ones = sum(1 << (j * like.bits) for j in range(each))
    ones -= 1 << 64 if ones >= 1 << 63 else 0
    differing = F.lit(0)
    for i in range(-(-like.minima // each)):
        x = a[i].bitwiseXOR(b[i])
        any_bit = x
        for s in range(1, like.bits):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, s))
        differing = differing + F.bit_count(any_bit.bitwiseAND(F.lit(ones).cast("long")))
    chance = 2.0**-like.bits
    return F.greatest(F.lit(0.0), ((like.minima - differing) / F.lit(float(like.minima)) - chance) / (1 - chance))


@dataclass
class Copies:
    """``members(record_id, class_id, loaded_at)``, ``classes(class_id, record_id, copies)`` and ``pairs(a, b, similarity, estimated)`` of classes, a < b."""

    members: DataFrame
    classes: DataFrame
    pairs: DataFrame


def near_copies(documents: DataFrame, like: Likeness = Likeness()) -> Copies:
    """Classes of equal sets of word runs, and all pairs of classes whose Jaccard similarity is ``least`` or more.

    ``documents(record_id, text, loaded_at)``; ids are compared in bare form.
    Records with one and the same set form one class before any pair is made,
    however many there are. Candidates are pairs of classes that share a band;
    they are narrowed by the corrected estimate where they meet and then
    checked exactly on the texts of the classes that are left. Buckets of any
    size are paired in blocks, see :func:`_met`.

    * Of a record delivered repeatedly the row with the latest loaded_at counts (NULL is oldest; ties: the larger digest).
    * Texts too short for a run of words are one class by equal words, without words by equal text; they are in no pair.
    * Texts below ``least_words`` (NULL and empty have none), NULL or empty record_id: in no class. NULL texts are never equal.
    * Very long texts are taken whole. Empty input: empty results. Other columns are ignored.
    """
    ws = Workspace(documents.sparkSession)
    rows = documents.select(hex_key("record_id").alias("record_id"), "loaded_at", "text").where(F.col("record_id") != "")
    prints = fingerprints(rows, like)
    newest = prints.groupBy("record_id").agg(F.max(F.struct("loaded_at", "digest", "words", "packed", "band_keys")).alias("r"))
    prints = ws.write(newest.select("record_id", "r.*").where(F.col("digest").isNotNull()))
    classes = prints.groupBy("digest").agg(
        F.min(F.struct("record_id", "loaded_at")).alias("r"), F.count(F.lit(1)).alias("copies"), F.first("words").alias("words"), F.first("packed").alias("packed"), F.first("band_keys").alias("band_keys")
    )
    classes = ws.write(classes.select(F.monotonically_increasing_id().alias("class_id"), "digest", "r.record_id", "r.loaded_at", "copies", "words", "packed", "band_keys"))
    members = spread_join(prints.select("record_id", "digest"), classes.select("digest", "class_id", "copies"), ["digest"], "record_id", size="copies").select("record_id", "class_id")
    asked = ws.write(_met(classes, like, ws))
    return Copies(members, classes.select("class_id", "record_id", "copies"), _checked(rows, classes, asked, like, ws))


def _met(classes: DataFrame, like: Likeness, ws: Workspace) -> DataFrame:
    """``(a, b, estimated, cell)``: pairs of classes that share a band and may be alike by their estimate.

    Only buckets of two or more are kept. A bucket is dealt out over blocks by
    the hash of the class, one for each ``BLOCK`` classes or ``BLOCK_WORDS``
    words, and each two of its blocks meet in a cell of their own: no task holds
    a bucket, and no pair is left out. Estimates are made there, from signatures
    that travel with the rows, so what may not be alike never leaves the cell.
    A pair that meets in several cells belongs to one of them.
    """
    postings = classes.select("class_id", "words", F.posexplode("band_keys").alias("band", "key")).select("class_id", "words", F.xxhash64("band", "key").alias("key"))
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("__w")).where(F.col("n") > 1)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("__w") / BLOCK_WORDS)).cast("int")
    live = spread_join(postings.drop("words"), sizes.select("key", "n", blocks.alias("blocks")), ["key"], "class_id", size="n")
    live = live.select("class_id", "key", "blocks", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int").alias("own"))
    live = ws.write(live.join(classes.select("class_id", "packed"), "class_id"))
    left = live.select(F.col("class_id").alias("x"), F.col("packed").alias("px"), "key", F.col("own").alias("i"), F.explode(F.sequence(F.col("own"), F.col("blocks") - 1)).alias("j"))
    right = live.select(F.col("class_id").alias("y"), F.col("packed").alias("py"), "key", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"))
    both = left.join(right, ["key", "i", "j"]).where((F.col("x") < F.col("y")) | ((F.col("x") > F.col("y")) & (F.col("i") < F.col("j"))))
    guess = both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), estimate(F.col("px"), F.col("py"), like).alias("estimated"), F.xxhash64("key", "i", "j").alias("cell"))
    near = guess.where(F.col("estimated") >= float(like.least) - like.margin)
    return near.groupBy("a", "b").agg(F.max("estimated").alias("estimated"), F.min("cell").alias("cell"))


def _checked(rows: DataFrame, classes: DataFrame, asked: DataFrame, like: Likeness, ws: Workspace) -> DataFrame:
    """Exact similarity of the pairs asked for, from the texts of their classes' representatives.

    The sets of a cell's classes travel to it once, not once for every pair,
    and go before its pairs; a task keeps the sets of one cell at a time.
    """
    ends = asked.select("cell", F.col("a").alias("class_id")).union(asked.select("cell", "b")).distinct()
    wanted = ends.select("class_id").distinct().join(classes.select("class_id", "digest", "record_id", "loaded_at"), "class_id")
    texts = rows.join(wanted.withColumnRenamed("loaded_at", "__at"), "record_id").where(F.col("loaded_at").eqNullSafe(F.col("__at")))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(like.words)
        for batch in batches:
            out = []
            for c, digest, text in zip(batch["class_id"], batch["digest"], batch["text"], strict=True):
                found = shingle(text)[1] if isinstance(text, str) else None
                if found is not None and xxhash.xxh3_128_hexdigest(found.tobytes()) == digest:
                    out.append((c, found.view(np.int64)))
            yield pd.DataFrame(out, columns=["class_id", "runs"])

    runs = ws.write(texts.select("class_id", "digest", "text").mapInPandas(sets, "class_id long, runs array<long>").dropDuplicates(["class_id"]))
    first = ends.join(runs, "class_id").select("cell", F.col("class_id").alias("a"), F.lit(-1).cast("long").alias("b"), F.lit(0.0).alias("estimated"), "runs")
    then = asked.select("cell", "a", "b", "estimated", F.lit(None).cast("array<long>").alias("runs"))
    least, most = like.least.numerator, like.least.denominator

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, {}
        for batch in batches:
            out = []
            for c, a, b, e, r in zip(batch["cell"], batch["a"], batch["b"], batch["estimated"], batch["runs"], strict=True):
                if c != cell:
                    cell, held = c, {}
                if b < 0:
                    held[a] = np.asarray(r).view(np.uint64)  # sorted and distinct
                    continue
                x, y = held[a], held[b]
                if len(x) > len(y):
                    x, y = y, x
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                whole = len(x) + len(y) - shared
                if shared * most >= whole * least:
                    out.append((a, b, shared / whole, e))
            yield pd.DataFrame(out, columns=["a", "b", "similarity", "estimated"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = first.unionByName(then).repartition(tasks, "cell").sortWithinPartitions("cell", "b")
    return ws.write(dealt.mapInPandas(compare, "a long, b long, similarity double, estimated double"))


def all_record_pairs(found: Copies, block: int = 256) -> DataFrame:
    """``(record_id_a, record_id_b)``, smaller first, for all alike records, copies written out.

    Only for a result that is defined by pairs of records; large classes are
    joined in blocks, so no task holds one whole.
    """
    member, sizes = found.members, found.classes.select("class_id", F.ceil(F.col("copies") / block).cast("int").alias("blocks"))
    linked = found.pairs.select("a", "b").union(found.classes.where(F.col("copies") > 1).select(F.col("class_id").alias("a"), F.col("class_id").alias("b")))
    right = sizes.select(F.col("class_id").alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    by_block = member.join(sizes, "class_id").select(F.col("class_id").alias("b"), F.col("record_id").alias("y"), F.pmod(F.xxhash64("record_id"), F.col("blocks")).cast("int").alias("block"))
    left = linked.join(right, "b").join(member.select(F.col("class_id").alias("a"), F.col("record_id").alias("x")), "a")
    both = left.join(by_block, ["b", "block"]).where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    return both.select(F.least("x", "y").alias("record_id_a"), F.greatest("x", "y").alias("record_id_b"))


def groups(found: Copies) -> DataFrame:
    """One row a record in a class: ``record_id, class_id`` (smallest record of equal sets), ``group_id`` (smallest record tied by similarity, step by step), ``copies, links`` (other classes it is alike)."""
    name = found.classes.select("class_id", F.col("record_id").alias("rep"), "copies")
    named = found.pairs.join(name.select(F.col("class_id").alias("a"), F.col("rep").alias("ra")), "a").join(name.select(F.col("class_id").alias("b"), F.col("rep").alias("rb")), "b")
    tied = hash_to_min(named.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).withColumnsRenamed({"v": "rep", "root": "group_id"})
    links = found.pairs.select(F.col("a").alias("class_id")).union(found.pairs.select("b")).groupBy("class_id").agg(F.count(F.lit(1)).alias("links"))
    rows = found.members.join(name, "class_id").join(links, "class_id", "left").join(tied, "rep", "left")
    return rows.select("record_id", F.col("rep").alias("class_id"), F.coalesce("group_id", "rep").alias("group_id"), "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/normalized_document.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records with a similarity of 0.7 or more on runs of three words."""
    return all_record_pairs(near_copies(_documents(spark, sf_dir), RECORDS))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and groups of all records, short ones included, with a similarity of 0.8 or more on runs of five words."""
    return groups(near_copies(_documents(spark, sf_dir), EVERY))


def p3_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alike classes with exact and estimated similarity, next to the greatest estimate that ``pairs`` holds for their representatives."""
    found = near_copies(_documents(spark, sf_dir), RECORDS)
    name = found.classes.select("class_id", F.col("record_id").alias("rep"))
    made = found.pairs.join(name.select(F.col("class_id").alias("a"), F.col("rep").alias("x")), "a").join(name.select(F.col("class_id").alias("b"), F.col("rep").alias("y")), "b")
    made = made.select(F.least("x", "y").alias("record_id_a"), F.greatest("x", "y").alias("record_id_b"), "similarity", "estimated")
    x, y = hex_key("id_a"), hex_key("id_b")
    given = spark.read.parquet(f"{sf_dir}/pairs.parquet").where(F.col("estimated_similarity").between(0, 1))
    given = given.groupBy(F.least(x, y).alias("record_id_a"), F.greatest(x, y).alias("record_id_b")).agg(F.max("estimated_similarity").alias("given"))
    return made.join(given, ["record_id_a", "record_id_b"], "left")


QUERIES = {"p3_found": p3_found, "p3_groups": p3_groups, "p3_pairs": p3_pairs}

_TEXTS = r"""
WITH RECURSIVE cur AS (
    SELECT lower(regexp_replace(record_id, '[^0-9A-Za-z]+', '', 'g')) AS id, text FROM normalized_document
    QUALIFY row_number() OVER (PARTITION BY lower(regexp_replace(record_id, '[^0-9A-Za-z]+', '', 'g')) ORDER BY loaded_at DESC NULLS LAST) = 1),
word AS (SELECT id, text, regexp_extract_all(lower(nfc_normalize(coalesce(text, ''))), '[\p{L}\p{N}]+') AS w FROM cur WHERE id <> '')
"""


def _runs(n: int) -> str:
    return f"list_sort(list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))))"


SQL = {
    # through an inverted index: no signatures, no bands
    "p3_found": _TEXTS + f""", sets AS (SELECT id, {_runs(3)} AS s FROM word WHERE len(w) >= 20),
post AS (SELECT id, len(s) AS n, unnest(s) AS g FROM sets)
SELECT x.id AS record_id_a, y.id AS record_id_b FROM post x JOIN post y ON x.g = y.g AND x.id < y.id
GROUP BY 1, 2 HAVING 10 * count(*) >= 7 * (any_value(x.n) + any_value(y.n) - count(*))""",
    "p3_groups": _TEXTS + f""", sets AS (SELECT id, CASE WHEN len(w) >= 5 THEN {_runs(5)} ELSE [] END AS s,
    CASE WHEN len(w) >= 5 THEN 's' || array_to_string({_runs(5)}, '|') WHEN len(w) > 0 THEN 'w' || array_to_string(w, ' ') WHEN text IS NOT NULL THEN 't' || text ELSE 'r' || id END AS k FROM word),
class AS (SELECT min(id) AS c, any_value(s) AS s, k, count(*) AS copies FROM sets GROUP BY k),
post AS (SELECT c, len(s) AS n, unnest(s) AS g FROM class),
near AS (SELECT x.c AS a, y.c AS b FROM post x JOIN post y ON x.g = y.g AND x.c <> y.c GROUP BY 1, 2 HAVING 5 * count(*) >= 4 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(v, u) AS (SELECT a, b FROM near UNION SELECT reach.v, near.b FROM reach JOIN near ON reach.u = near.a),
grouped AS (SELECT v, min(u) AS g FROM (SELECT v, u FROM reach UNION ALL SELECT c, c FROM class) GROUP BY v)
SELECT id AS record_id, c AS class_id, g AS group_id, copies, (SELECT count(*) FROM near WHERE a = c) AS links
FROM sets JOIN class USING (k) JOIN grouped ON v = c""",
}
