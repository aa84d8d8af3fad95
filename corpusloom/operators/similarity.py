"""Pairs of alike texts: exact set joins, MinHash candidates, scores and summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions.shingles import band_keys, containment, jaccard, portable_hashes, portable_minhash, shingle_set, signature_similarity
from ..functions.text import normalized_title, shingle_words, title_tokens
from ..functions.urls import url_host
from ..runtime import Workspace, spread_join
from .graph import connected_components

#: Documents from which a shingle counts as frequent in the order of prefixes.
FREQUENT = 50
#: Configurations of bands, by the bit of a mask that stands for them.
MASK_NAMES = ("word5_128_32x4", "word5_128_8x16")
#: Members, and elements of their sets, of a block of a bucket.
BLOCK, BLOCK_ELEMENTS = 512, 2_000_000


def shingle_sets(documents: DataFrame, n: int, *keep: str) -> DataFrame:
    """The kept columns with ``shingles``, the set of word n-grams of ``text``.

    In two projections: words are found once a text, not once for every use.
    Sets should be unfolded with explode_outer: with explode a filter for empty
    sets is inferred and moved below, and every set is made twice.
    """
    words = documents.select(*keep, shingle_words("text").alias("__words"))
    return words.select(*keep, shingle_set("__words", n).alias("shingles"))


def shingled(documents: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """``(key, shingles)`` with distinct n-grams as 64-bit hashes; texts without words are left out.

    Words are hashed once and runs of hashes are hashed again, so no n-gram is
    ever spelled out. A text of fewer than n words is one marked shingle.
    """
    # the raw text is asked for a word: a filter on the result would be moved below and make the whole set twice
    told = documents.where(F.col(key).isNotNull() & F.col("text").rlike(r"[\p{L}\p{N}_]"))
    words = told.select(key, shingle_words("text").alias("__words"))
    hashed = words.select(key, F.transform("__words", lambda w: F.xxhash64(w)).alias("__h"))
    count = F.greatest(F.size("__h") - (n - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("__h", k + 1, count).alias(f"w{k}") for k in range(n)])
    runs = F.array_distinct(F.transform(zipped, lambda x: F.xxhash64(*[x[f"w{k}"] for k in range(n)])))
    whole = F.array(F.xxhash64(F.lit("short"), F.col("__h")))
    return hashed.select(key, F.when(F.size("__h") >= n, runs).otherwise(whole).alias("shingles"))


def portable_signatures(documents: DataFrame, n: int, permutations: int, key: str = "doc_id") -> DataFrame:
    """``(key, signature)`` in the portable family; NULL for texts without words."""
    hashed = shingle_sets(documents, n, key).select(key, portable_hashes("shingles").alias("__h"))
    return hashed.select(key, portable_minhash("__h", permutations).alias("signature"))


def shingle_frequency(documents: DataFrame, n: int, least: int = 1) -> DataFrame:
    """In how many documents each n-gram occurs, from ``least`` on."""
    counts = shingle_sets(documents, n).select(F.explode_outer("shingles").alias("shingle")).where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.count(F.lit(1)).alias("documents"))
    return counts.where(F.col("documents") >= least)


def met_in_blocks(postings: DataFrame, weight: str, carry: Sequence[str] = (), block: int = BLOCK, block_weight: int = BLOCK_ELEMENTS) -> DataFrame:
    """``(x, y, cell, size)`` and the carried columns with both suffixes for each two members of a bucket; ``postings(key, id, weight, carry...)``.

    A bucket is dealt out over blocks by the hash of the member, one for each
    ``block`` members or ``block_weight`` of weight, and each two of its blocks
    meet in a cell of their own: no task holds a bucket and no pair is left
    out. Buckets of one are dropped first. A pair comes once for each bucket;
    ``size`` is the bucket's.
    """
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("__n"), F.sum(weight).alias("__w")).where(F.col("__n") > 1)
    blocks = F.greatest(F.ceil(F.col("__n") / block), F.ceil(F.col("__w") / block_weight)).cast("int")
    live = spread_join(postings, sizes.select("key", "__n", blocks.alias("__blocks")), ["key"], "id", size="__n")
    live = Workspace(postings.sparkSession).write(live.withColumn("own", F.pmod(F.xxhash64("id"), F.col("__blocks")).cast("int")))  # read twice
    left = live.select("key", F.col("id").alias("x"), F.col("__n").alias("size"), *[F.col(c).alias(f"{c}_x") for c in carry], F.col("own").alias("i"), F.explode(F.sequence(F.col("own"), F.col("__blocks") - 1)).alias("j"))
    right = live.select("key", F.col("id").alias("y"), *[F.col(c).alias(f"{c}_y") for c in carry], F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"))
    both = left.join(right, ["key", "i", "j"]).where((F.col("x") < F.col("y")) | ((F.col("x") > F.col("y")) & (F.col("i") < F.col("j"))))
    return both.withColumn("cell", F.xxhash64("key", "i", "j")).drop("key", "i", "j")


def shared_in_cells(asked: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, shared, na, nb)``: sizes of two sets and of what they share, for ``asked(a, b, cell)`` and ``sets(id, runs)`` of whole numbers.

    The sets of a cell travel to it once, not once for every pair, and go
    before its pairs; a task keeps the sets of one cell at a time.
    """
    kind = dict(asked.dtypes)["a"]
    ends = asked.select("cell", F.col("a").alias("id")).union(asked.select("cell", "b")).distinct()
    first = ends.join(sets.select("id", "runs"), "id").select("cell", F.lit(0).alias("turn"), F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"), F.array_sort("runs").alias("runs"))
    then = asked.select("cell", F.lit(1).alias("turn"), F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.lit(None).cast("array<long>").alias("runs"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, {}
        for batch in batches:
            out = []
            for c, turn, a, b, r in zip(batch["cell"], batch["turn"], batch["a"], batch["b"], batch["runs"], strict=True):
                if c != cell:
                    cell, held = c, {}
                if turn == 0:
                    held[a] = np.asarray(r, dtype=np.int64)
                    continue
                x, y = held[a], held[b]
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                shared = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum()) if len(few) else 0
                out.append((a, b, shared, len(x), len(y)))
            yield pd.DataFrame(out, columns=["a", "b", "shared", "na", "nb"])

    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = first.unionByName(then).repartition(tasks, "cell").sortWithinPartitions("cell", "turn")
    found = dealt.mapInPandas(compare, "a string, b string, shared long, na long, nb long")
    return found.withColumns({"a": F.col("a").cast(kind), "b": F.col("b").cast(kind)})


def similar_pairs(sets: DataFrame, least: float, key: str = "doc_id", frequent: int = FREQUENT) -> DataFrame:
    """All pairs of sets with Jaccard similarity ``least`` or more: ``a, b, similarity, cell``, representative sets only.

    Exact, by prefix filtering: in any common order of elements, two sets that
    are alike share an element among the first |s| - ceil(least |s|) + 1 of
    each. Rare elements come first in the order, so prefixes hold few frequent
    ones; sizes and the places of a shared element rule out most of the rest,
    and an element that many prefixes hold is met in blocks. Equal sets are one
    class: the result has pairs of classes' smallest keys; :func:`set_classes`
    has their members. ``cell`` tells where a pair met, for further comparisons.
    """
    ws = Workspace(sets.sparkSession)  # sets are read several times, texts once
    classes = set_classes(ws.write(sets.select(key, "shingles")), key)
    # rows are full of ids: representatives are numbered, which moves a fraction of what their names would
    reps = classes.where(F.col(key) == F.col("class_id")).select(F.col(key).alias("name"), "shingles")
    reps = ws.write(reps.select(F.monotonically_increasing_id().alias("id"), "name", "shingles"))
    counts = reps.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= frequent)
    ranked = reps.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s")).join(counts, "s", "left")
    order = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "s")
    prefix = ranked.groupBy("id", "n").agg(F.array_sort(F.collect_list(order)).alias("o"))  # a document's own elements
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1
    prefix = prefix.select("id", "n", F.posexplode(F.slice("o.s", F.lit(1), keep.cast("int"))).alias("at", "key"))
    met = met_in_blocks(prefix, "n", ("n", "at"))
    short, long = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
    most = F.least("at_x", "at_y") + 1 + F.least(F.col("n_x") - F.col("at_x") - 1, F.col("n_y") - F.col("at_y") - 1)
    may = (short >= long * F.lit(least) - 1e-9) & (most >= (F.col("n_x") + F.col("n_y")) * F.lit(least / (1 + least)) - 1e-9)
    asked = ws.write(met.where(may).groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.min("cell").alias("cell")))
    found = shared_in_cells(asked, reps.select("id", F.col("shingles").alias("runs"))).withColumn("similarity", F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")))
    found = ws.write(found.where(F.col("similarity") >= least - 1e-12).select("a", "b", "similarity")).join(asked, ["a", "b"])
    x, y = (reps.select(F.col("id").alias(k), F.col("name").alias(f"n{k}")) for k in "ab")
    return found.join(x, "a").join(y, "b").select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"), "similarity", "cell")


def set_classes(sets: DataFrame, key: str = "doc_id") -> DataFrame:
    """``sets`` with ``class_id``: the smallest key among equal sets."""
    told = sets.withColumn("__set", F.sha2(F.array_join(F.transform(F.array_sort("shingles"), lambda x: x.cast("string")), ","), 256))
    first = told.groupBy("__set").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("__copies"))
    return spread_join(told, first, ["__set"], key, size="__copies").drop("__set", "__copies")


def bucket_postings(signatures: DataFrame, bands: int, rows: int, key: str = "doc_id", config: str = "") -> DataFrame:
    """``(config, band, bucket, key)`` for every band of every signature; NULL signatures have none."""
    exploded = signatures.where(F.col("signature").isNotNull()).select(key, F.posexplode(band_keys("signature", bands, rows)).alias("band", "bucket"))
    return exploded.select(F.lit(config or f"{bands}x{rows}").alias("config"), "band", "bucket", key)


def bucket_metrics(postings: DataFrame) -> DataFrame:
    """For each configuration: buckets of two or more, members, largest, nearest-rank percentiles of size, pairs before dropping repeats."""
    sizes = postings.groupBy("config", "band", "bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return sizes.groupBy("config").agg(
        F.count(F.lit(1)).alias("buckets"), F.sum("size").alias("members"), F.max("size").alias("largest"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY size)").cast("long").alias("p50"), F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY size)").cast("long").alias("p90"),
        F.sum(F.expr("size * (size - 1) div 2")).alias("pairs"),
    )


def candidate_pairs(postings: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pairs that share a bucket: ``a, b, hits, largest_bucket, configs``. Every member of a bucket is paired, in blocks; none is left out for its size."""
    told = postings.select(F.xxhash64("config", "band", "bucket").alias("key"), F.col(key).alias("id"), "config", F.lit(1).alias("one"))
    met = met_in_blocks(told, "one", ("config",))
    return met.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(
        F.count(F.lit(1)).alias("hits"), F.max("size").alias("largest_bucket"), F.array_sort(F.collect_set("config_x")).alias("configs")
    )


def merged_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs in one order, repeats merged: masks by OR, hits by sum, bucket sizes and estimates by maximum. NULL ids and a record with itself are left out."""
    a, b = F.least("id_a", "id_b"), F.greatest("id_a", "id_b")
    rows = pairs.where(F.col("id_a").isNotNull() & F.col("id_b").isNotNull() & (F.col("id_a") != F.col("id_b")))
    return rows.groupBy(a.alias("id_a"), b.alias("id_b")).agg(
        F.bit_or("config_mask").alias("config_mask"), F.sum("bucket_hits").alias("bucket_hits"), F.max("max_bucket_size").alias("max_bucket_size"), F.max("estimated_similarity").alias("estimated_similarity")
    )


def with_endpoints(pairs: DataFrame, records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs with the named columns of both records, suffixed _a and _b; pairs of unknown records are left out."""
    left = records.select(F.col("record_id").alias("id_a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = records.select(F.col("record_id").alias("id_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.join(left, "id_a").join(right, "id_b")


def described_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with endpoints ``source, subset, words`` described by bands, relations and the names of the configurations that found them. Nothing is ever marked for removal."""
    names = F.array_compact(F.array(*[F.when(F.col("config_mask").bitwiseAND(1 << i) > 0, n) for i, n in enumerate(MASK_NAMES)]))
    pairs = pairs.withColumns({"configs": names, "removal_eligible": F.lit(False)})
    return pairs.withColumns(
        {
            "similarity_band": B.similarity_band("estimated_similarity"), "tail_band": B.tail_band("estimated_similarity"), "bucket_band": B.bucket_band("max_bucket_size"),
            "length_ratio": B.ratio("words_a", "words_b"), "relation": B.relation("source_a", "source_b"),
            "pair_key": B.unordered_pair(B.source_subset("source_a", "subset_a"), B.source_subset("source_b", "subset_b")),
            "length_band": B.length_band(F.least("words_a", "words_b")),
        }
    ).withColumn("ratio_band", B.ratio_band("length_ratio"))


def pair_summary(described: DataFrame, by: Sequence[str]) -> DataFrame:
    """Pairs, mean similarity and distinct endpoints by the given columns."""
    rows = described.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("estimated_similarity"), 9).alias("mean_similarity"))
    ends = described.select(*by, F.explode(F.array("id_a", "id_b")).alias("id")).groupBy(*by).agg(F.count_distinct("id").alias("records"))
    return rows.join(ends, list(by))


def pair_summaries(described: DataFrame, preserved: Sequence[str]) -> DataFrame:
    """All summaries of candidates in one table: ``scope, value, pairs, mean_similarity, records``.

    Scopes: each side's source and subset, each side's source, unordered pair by
    length ratio, similarity by partition (with or without preserved sources)
    and length, length, ratio, relation. A pair counts once for a value that
    both of its sides have.
    """
    partition = F.when(F.col("source_a").isin(*preserved) | F.col("source_b").isin(*preserved), "with_preserved").otherwise("without_preserved")
    one = lambda *c: F.array(F.concat_ws(" : ", *c))
    scopes = {
        "source_subset": F.array_distinct(F.array(B.source_subset("source_a", "subset_a"), B.source_subset("source_b", "subset_b"))), "source": F.array_distinct(F.array("source_a", "source_b")),
        "pair_ratio": one("pair_key", "ratio_band"), "similarity_partition_length": one("similarity_band", partition, "length_band"), "length": F.array("length_band"), "ratio": F.array("ratio_band"),
        "relation": F.array("relation"),
    }
    told = F.explode(F.array(*[F.struct(F.lit(n).alias("scope"), F.array_compact(v).alias("values")) for n, v in scopes.items()]))
    rows = described.select("id_a", "id_b", "estimated_similarity", told.alias("s")).select("id_a", "id_b", "estimated_similarity", "s.scope", F.explode("s.values").alias("value"))
    return pair_summary(rows, ["scope", "value"])


def scored_pairs(pairs: DataFrame, documents: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """Exact scores of given pairs ``(a, b)`` on n-grams: jaccard, containment in both directions and the smaller, shared, only in one.

    Texts of the pairs' documents only are read into sets. Pairs with a
    ``cell`` (from :func:`similar_pairs`) are compared there; others at their
    first document. Texts without words share nothing with any.
    """
    ws = Workspace(documents.sparkSession)
    placed = ws.write(pairs.select("a", "b", "cell" if "cell" in pairs.columns else F.xxhash64("a").alias("cell")))
    wanted = placed.select(F.col("a").alias(key)).union(placed.select("b")).distinct()
    texts = documents.join(wanted, key, "left_semi")
    sets = wanted.join(shingled(texts, n, key), key, "left").select(F.col(key).alias("id"), F.coalesce("shingles", F.array().cast("array<long>")).alias("runs"))
    both = shared_in_cells(placed, ws.write(sets)).withColumnsRenamed({"na": "nx", "nb": "ny"})
    shared, nx, ny = F.col("shared"), F.col("nx"), F.col("ny")
    whole, low = nx + ny - shared, F.least("nx", "ny")
    rows = both.withColumns(
        {
            "jaccard": F.when(whole > 0, shared / whole).otherwise(0.0), "containment": F.when(low > 0, shared / low).otherwise(0.0), "only_a": nx - shared, "only_b": ny - shared,
            "a_in_b": F.when(nx > 0, shared / nx).otherwise(0.0), "b_in_a": F.when(ny > 0, shared / ny).otherwise(0.0), "length_ratio": B.ratio(nx, ny),
        }
    )
    return rows.drop("nx", "ny").withColumn("flags", B.containment_flags("containment", "jaccard", "length_ratio", "shared"))


def distinctive_scores(pairs: DataFrame, documents: DataFrame, n: int, least: int = 3, key: str = "doc_id") -> DataFrame:
    """Jaccard and containment on n-grams that occur in fewer than ``least`` documents, and the frequent part of the n-grams that a pair shares (0 if it shares none).

    Frequencies are counted over all documents. Pairs meet as in :func:`scored_pairs`.
    """
    ws = Workspace(documents.sparkSession)
    placed = ws.write(pairs.select("a", "b", "cell" if "cell" in pairs.columns else F.xxhash64("a").alias("cell")))
    sets = ws.write(shingled(documents, n, key))
    common = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("s", F.lit(True).alias("c"))
    wanted = placed.select(F.col("a").alias(key)).union(placed.select("b")).distinct()
    each = sets.join(wanted, key, "left_semi").select(key, F.explode("shingles").alias("s")).join(common, "s", "left")
    told = each.groupBy(key).agg(F.collect_list(F.when(F.col("c").isNull(), F.col("s"))).alias("rare"), F.collect_list(F.when(F.col("c"), F.col("s"))).alias("common"))  # a document's own n-grams
    told = ws.write(wanted.join(told, key, "left").select(F.col(key).alias("id"), *[F.coalesce(c, F.array().cast("array<long>")).alias(c) for c in ("rare", "common")]))
    rare = shared_in_cells(placed, told.select("id", F.col("rare").alias("runs")))
    often = shared_in_cells(placed, told.select("id", F.col("common").alias("runs"))).select("a", "b", F.col("shared").alias("common"))
    both = rare.join(often, ["a", "b"])
    whole, low, shared = F.col("na") + F.col("nb") - F.col("shared"), F.least("na", "nb"), F.col("shared") + F.col("common")
    return both.select(
        "a", "b", F.when(whole > 0, F.col("shared") / whole).otherwise(0.0).alias("distinctive_jaccard"), F.when(low > 0, F.col("shared") / low).otherwise(0.0).alias("distinctive_containment"),
        F.when(shared > 0, F.col("common") / shared).otherwise(0.0).alias("common_share"),
    )


def judged_pairs(pairs: DataFrame, documents: DataFrame, n: int, boundaries: Sequence[float], preserved: Sequence[str], least: int = 3, nearest: int = 8) -> DataFrame:
    """Given pairs ``(a, b)`` with all scores on n-grams, both records' sources and words, flags, ``categories``, ``label`` and ``action``.

    ``documents(doc_id, text, source, words, title, original_url)``. The
    ``nearest`` pairs of each boundary are at a boundary. NULL or empty titles
    and URLs agree with nothing. Texts stay where they are but for their first
    300 characters.
    """
    ws = Workspace(documents.sparkSession)
    scores = ws.write(scored_pairs(pairs, documents, n).drop("length_ratio", "flags"))
    told = documents.select(
        F.col("doc_id").alias("record_id"), "source", "words", F.substring("text", 1, 300).alias("head"), normalized_title("title").alias("full_title"), title_tokens("title").alias("title"),
        url_host("original_url").alias("host"),
    )
    rows = scores.join(distinctive_scores(pairs, documents, n, least), ["a", "b"])
    rows = with_endpoints(rows.withColumnsRenamed({"a": "id_a", "b": "id_b"}), told, ("source", "words", "head", "full_title", "title", "host")).withColumnsRenamed({"id_a": "a", "id_b": "b"})
    edge = closest_to(scores.select("a", "b", "jaccard"), "jaccard", boundaries, nearest, ("a", "b")).select("a", "b", F.lit(True).alias("boundary"))
    rows = rows.join(F.broadcast(edge), ["a", "b"], "left").withColumn("boundary", F.coalesce("boundary", F.lit(False)))  # nearest x boundaries rows
    titles = F.when((F.size("title_a") > 0) & (F.size("title_b") > 0), jaccard("title_a", "title_b"))
    rows = rows.withColumns({"title_similarity": titles, "length_ratio": B.ratio("words_a", "words_b")}).withColumn("boilerplate", B.boilerplate_suspect("jaccard", "title_similarity", "head_a", "head_b"))
    rows = rows.withColumn("flags", B.containment_flags("containment", "jaccard", "length_ratio", "shared"))
    kept = F.coalesce(F.col("source_a").isin(*preserved), F.lit(False)) | F.coalesce(F.col("source_b").isin(*preserved), F.lit(False))
    related = F.coalesce(F.col("full_title_a") == F.col("full_title_b"), F.lit(False)) | F.coalesce(F.col("host_a") == F.col("host_b"), F.lit(False))
    names = ("boundary", "jaccard", "source_a", "source_b", "host_a", "host_b", "boilerplate", "flags", "words_a", "words_b")
    rows = rows.withColumns({"preserved": kept, "categories": B.review_categories({c: F.col(c) for c in names})})
    label = B.provisional_label("jaccard", F.greatest("a_in_b", "b_in_a"), "distinctive_jaccard", "common_share", "length_ratio", related, "preserved")
    return rows.withColumns({"label": label, "action": B.short_action(F.least("words_a", "words_b"), "preserved")}).drop("head_a", "head_b", "title_a", "title_b", "full_title_a", "full_title_b")


#: Policies of acceptance as (name, texts of 20 words or more, rare n-grams alike).
POLICIES = (("P1", False, False), ("P2", True, False), ("P3", True, False), ("P4", True, True))


def policy_matrix(judged: DataFrame, threshold: float = 0.85) -> DataFrame:
    """What each policy accepts of :func:`judged_pairs`: pairs, those labelled as duplicates, precision by label, and recall of all pairs of ``threshold`` or more.

    P3 differs from P2 only in that it reports containment (``contained``)
    beside what it accepts. Pairs of preserved sources are never accepted.
    """
    alike = F.coalesce(F.col("jaccard") >= threshold, F.lit(False))
    positive = F.col("label").isin("true duplicate", "probable duplicate")
    parts = None
    for name, short, distinctive in POLICIES:
        passes = alike
        if short:
            passes = passes & (F.least("words_a", "words_b") >= 20)
        if distinctive:
            passes = passes & (F.col("distinctive_jaccard") >= 0.75)
        taken = passes & ~F.col("preserved")
        part = judged.agg(
            F.count_if(taken).alias("accepted"), F.count_if(taken & positive).alias("duplicates"), F.count_if(alike).alias("alike"), F.count_if(passes).alias("alike_accepted"),
            F.count_if(F.lit(name in ("P3", "P4")) & (F.col("label") == "containment case")).alias("contained"),
        ).withColumn("policy", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    rate = [F.round(F.col(x) / F.nullif(F.col(y), F.lit(0)), 9).alias(n) for x, y, n in (("duplicates", "accepted", "precision"), ("alike_accepted", "alike", "recall"))]
    return parts.select("policy", "accepted", "duplicates", "alike", "alike_accepted", "contained", *rate)


def tail_summary(judged: DataFrame) -> DataFrame:
    """Alike pairs by tail band and what they have in common: unordered pair of sources, sources, hosts and containment flags (these in any band); ``scope, value, tail, partition, pairs``."""
    tail = B.tail_band("jaccard")
    partition = F.when(F.col("preserved"), "with_preserved").otherwise("without_preserved")
    sources = F.array_distinct(F.array("source_a", "source_b"))
    hosts = F.array_distinct(F.array("host_a", "host_b"))
    scopes = {"source_pair": F.array(B.unordered_pair("source_a", "source_b")), "source": sources, "host": hosts, "containment_flag": F.col("flags")}
    parts = None
    for name, values in scopes.items():
        part = judged.select(F.lit(name).alias("scope"), F.explode(F.array_compact(values)).alias("value"), tail.alias("tail"), partition.alias("partition"))
        part = part if name == "containment_flag" else part.where(F.col("tail").isNotNull())
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("scope", "value", "tail", "partition").agg(F.count(F.lit(1)).alias("pairs"))


def review_pool(judged: DataFrame, rank: Column, each: int = 12, most: int = 100) -> DataFrame:
    """A sample of pairs for people to read: the ``each`` of smallest rank of every category (pairs without one are ``uncategorized``), then the ``most`` that matter most.

    First pairs of preserved sources, then the pair of reference works, then
    frequent n-grams, then containment; then by falling similarity and ids.
    """
    names = F.when(F.size("categories") > 0, F.col("categories")).otherwise(F.array(F.lit("uncategorized")))
    tagged = judged.withColumn("category", F.explode(names)).withColumn("__r", rank)
    w = Window.partitionBy("category").orderBy("__r", "a", "b")
    few = tagged.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= each).groupBy("a", "b").agg(
        *[F.first(c).alias(c) for c in ("preserved", "source_a", "source_b", "common_share", "a_in_b", "b_in_a", "jaccard", "label")]
    )
    x, y = F.least("source_a", "source_b"), F.greatest("source_a", "source_b")
    priority = (
        F.when(F.col("preserved"), 0).when((x == "carolina") & (y == "wikipediapt"), 1).when(F.col("common_share") >= 0.5, 2).when(F.greatest("a_in_b", "b_in_a") >= 0.8, 3).otherwise(4)
    )
    return few.withColumn("priority", priority).orderBy("priority", F.desc("jaccard"), "a", "b").limit(most).select("a", "b", "priority", "label")


def estimate_error(pairs: DataFrame, signatures: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pairs with exact ``jaccard`` and their signatures' estimate."""
    x, y = (signatures.select(F.col(key).alias(k), F.col("signature").alias(f"s{k}")) for k in "ab")
    return pairs.join(x, "a").join(y, "b").withColumn("estimated", signature_similarity("sa", "sb")).drop("sa", "sb")


def recall_table(gold: DataFrame, generated: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Recall and precision of generated pairs against exactly scored ones at each threshold."""
    made = generated.select("a", "b").distinct().withColumn("made", F.lit(True))
    scored = gold.select("a", "b", "jaccard").join(made, ["a", "b"], "full")
    per = scored.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    good = F.coalesce(F.col("jaccard") >= F.col("threshold"), F.lit(False))
    hit = good & F.coalesce("made", F.lit(False))
    rows = per.groupBy("threshold").agg(F.count_if(good).alias("positives"), F.count_if(F.coalesce("made", F.lit(False))).alias("generated"), F.count_if(hit).alias("hits"))
    return rows.withColumn("recall", F.round(F.col("hits") / F.nullif(F.col("positives"), F.lit(0)), 9)).withColumn("precision", F.round(F.col("hits") / F.nullif(F.col("generated"), F.lit(0)), 9))


def threshold_sweep(pairs: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """For each threshold: accepted pairs, clusters of two or more, records in them, and records that one owner a cluster would leave over."""
    rows = None
    for t in thresholds:
        kept = pairs.where(F.col("estimated_similarity") >= t)
        found = connected_components(kept.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
        sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
        told = sizes.agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"))
        one = kept.agg(F.count(F.lit(1)).alias("pairs")).crossJoin(F.broadcast(told)).withColumn("threshold", F.lit(float(t)))  # one row each
        rows = one if rows is None else rows.unionByName(one)
    return rows


def owners(components: DataFrame, records: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The owner of each component under an order, and the members it stands for: ``component, owner_id, members``."""
    joined = components.join(records, components["id"] == records["record_id"])
    best = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("record_id").alias("id")))
    return joined.groupBy("component").agg(best.alias("w"), F.count(F.lit(1)).alias("members")).select("component", F.col("w.id").alias("owner_id"), "members")


#: The order of curated sources, and the tiers of all others.
CURATED_ORDER = ("gutenbergpt", "wikipediapt", "carolina")
OTHER_TIER = 9


def claim(end: str, tiers: dict[str, int]) -> Column:
    """What a record's claim to own a pair or a cluster is ordered by: curated sources first, then the tier of the subset, then more words, then the id.

    ``end`` is the suffix of ``source, subset, words, record_id`` (``_a``, ``_b`` or none).
    """
    source = F.col(f"source{end}")
    rank = F.lit(OTHER_TIER)
    for i, name in enumerate(CURATED_ORDER):
        rank = F.when(source == name, i).otherwise(rank)
    rank = F.when(source == "gigaverbov2", len(CURATED_ORDER)).otherwise(rank)
    by_subset = F.lit(5)
    for subset, tier in tiers.items():
        by_subset = F.when(F.col(f"subset{end}") == subset, tier).otherwise(by_subset)
    tier = F.when(source.isin(*CURATED_ORDER), 0).when(source == "gigaverbov2", by_subset).otherwise(OTHER_TIER)
    return F.struct(tier.alias("tier"), rank.alias("rank"), (-F.coalesce(f"words{end}", F.lit(0))).alias("words"), F.col(f"record_id{end}").alias("id"))


def pair_owner(tiers: dict[str, int]) -> Column:
    """The better record of a pair by :func:`claim`; an encyclopedia owns what a curated collection took from it.

    That is so where the collection's record has ``wik`` in its subset or
    ``wikipedia`` in its URL. Needs ``source, subset, words, record_id, original_url`` with both suffixes.
    """

    def taken(mine: str, other: str) -> Column:
        marked = F.coalesce(F.col(f"subset{mine}").contains("wik"), F.lit(False)) | F.coalesce(F.lower(f"original_url{mine}").contains("wikipedia"), F.lit(False))
        return (F.col(f"source{mine}") == "carolina") & (F.col(f"source{other}") == "wikipediapt") & marked

    best = F.least(claim("_a", tiers), claim("_b", tiers))["id"]
    return F.when(taken("_a", "_b"), F.col("record_id_b")).when(taken("_b", "_a"), F.col("record_id_a")).otherwise(best)


def closest_to(pairs: DataFrame, value: str, boundaries: Sequence[float], k: int, key: Sequence[str]) -> DataFrame:
    """The k pairs nearest to each boundary, ties by key; a pair near several boundaries comes once, with all of them."""
    near = pairs.withColumn("boundary", F.explode(F.array(*[F.lit(float(b)) for b in boundaries])))
    w = Window.partitionBy("boundary").orderBy(F.round(F.abs(F.col(value) - F.col("boundary")), 12), *key)
    few = near.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k)
    return few.groupBy(*key).agg(F.max(value).alias(value), F.array_sort(F.collect_set("boundary")).alias("boundaries"))
