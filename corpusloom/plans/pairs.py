"""Alike texts, candidate pairs and their graphs over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions.keys import hex_key
from ..functions.shingles import PRIME, fast_minhash, jaccard, portable_coefficients
from ..functions.text import title_tokens
from ..operators import similarity as S
from ..operators import verify as V
from ..operators.graph import connected_components
from ..runtime import Workspace
from .base import ND, REC, RULE, SUBSET_TIER, documents, hex_sql, read, records

THRESHOLDS = (0.8, 0.85, 0.9, 0.92, 0.95)
PERMUTATIONS, BANDS, ROWS = 16, 8, 2
#: Fixed values: (name, words of an n-gram, permutations, bands, rows a band).
CONFIGURATIONS = [
    ("word5_64_16x4", 5, 64, 16, 4), ("word5_64_8x8", 5, 64, 8, 8), ("word5_128_32x4", 5, 128, 32, 4), ("word5_128_16x8", 5, 128, 16, 8), ("word5_128_8x16", 5, 128, 8, 16),
    ("word5_256_32x8", 5, 256, 32, 8), ("word5_256_16x16", 5, 256, 16, 16), ("word5_256_8x32", 5, 256, 8, 32), ("word3_128_32x4", 3, 128, 32, 4), ("word7_128_32x4", 7, 128, 32, 4),
]


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Merged pairs with usable estimates; ids in bare form."""
    rows = read(spark, d, "pairs").select(hex_key("id_a").alias("id_a"), hex_key("id_b").alias("id_b"), "config_mask", "bucket_hits", "max_bucket_size", "estimated_similarity")
    return S.merged_pairs(rows.where(F.col("estimated_similarity").between(0, 1)))


def _described(spark: SparkSession, d: str) -> DataFrame:
    return S.described_pairs(S.with_endpoints(_pairs(spark, d), records(spark, d).select("record_id", "source", "subset", "words"), ("source", "subset", "words")))


def merged_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs merged over repeats and orders."""
    return _pairs(spark, d)


def described_pairs(spark: SparkSession, d: str) -> DataFrame:
    """J6, PF8, PF16, PF17: pairs with their records' bands and relations."""
    return _described(spark, d).select(
        "id_a", "id_b", "similarity_band", "tail_band", "bucket_band", "length_band", "ratio_band", "relation", "pair_key", F.round("length_ratio", 9).alias("length_ratio"),
        F.array_join("configs", ";").alias("configs"), "removal_eligible",
    )


def candidate_summary(spark: SparkSession, d: str) -> DataFrame:
    """Pairs and endpoints by similarity and relation."""
    return S.pair_summary(_described(spark, d), ["similarity_band", "relation"])


def candidate_summaries(spark: SparkSession, d: str) -> DataFrame:
    """All summaries of candidates."""
    return S.pair_summaries(_described(spark, d), RULE.preserved)


def pair_errors(spark: SparkSession, d: str) -> DataFrame:
    """V5: which rules rows of pairs break, and how often."""
    rows = read(spark, d, "pairs").select(hex_key("id_a").alias("a"), hex_key("id_b").alias("b"), "estimated_similarity", "bucket_hits", "max_bucket_size", "config_mask")
    return V.pair_errors(rows, records(spark, d).select("record_id"))


def source_pair_summary(spark: SparkSession, d: str) -> DataFrame:
    """Pairs and endpoints by unordered pair of collections and length ratio."""
    return S.pair_summary(_described(spark, d), ["pair_key", "ratio_band"])


def pair_components(spark: SparkSession, d: str) -> DataFrame:
    """Components of pairs of 0.85 or more."""
    return connected_components(_pairs(spark, d).where("estimated_similarity >= 0.85").select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))


def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Clusters at each threshold."""
    return S.threshold_sweep(_pairs(spark, d), THRESHOLDS)


def cluster_owners(spark: SparkSession, d: str) -> DataFrame:
    """The owner of each component: curated sources in their order, then lower tier, more words, smaller id."""
    rows = records(spark, d).select("record_id", "source", "subset", "words")
    return S.owners(pair_components(spark, d), rows, (S.claim("", RULE.tiers),))


def pair_owners(spark: SparkSession, d: str) -> DataFrame:
    """The better record of each pair; the encyclopedia before what was taken from it."""
    rows = records(spark, d, "original_url").select("record_id", "source", "subset", "words", "original_url")
    both = S.with_endpoints(_pairs(spark, d), rows, ("source", "subset", "words", "original_url")).withColumns({"record_id_a": F.col("id_a"), "record_id_b": F.col("id_b")})
    return both.select("id_a", "id_b", S.pair_owner(RULE.tiers).alias("owner_id"))


def review_panel(spark: SparkSession, d: str) -> DataFrame:
    """The eight pairs nearest to each boundary."""
    out = S.closest_to(_pairs(spark, d).select("id_a", "id_b", "estimated_similarity"), "estimated_similarity", THRESHOLDS, 8, ("id_a", "id_b"))
    return out.select("id_a", "id_b", "estimated_similarity", F.array_join(F.transform("boundaries", lambda x: x.cast("string")), ";").alias("boundaries"))


def title_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Jaccard similarity of titles' words of pairs."""
    rows = records(spark, d, title_tokens("title").alias("t")).select("record_id", "t")
    both = S.with_endpoints(_pairs(spark, d), rows, ("t",))
    return both.select("id_a", "id_b", F.round(jaccard("t_a", "t_b"), 9).alias("title_jaccard"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d, "text").select(F.col("record_id").alias("doc_id"), "text")


def shingle_frequency(spark: SparkSession, d: str) -> DataFrame:
    """How many 5-grams occur in how many documents."""
    return S.shingle_frequency(_texts(spark, d), 5).groupBy("documents").agg(F.count(F.lit(1)).alias("shingles"))


def similar_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of 0.8 or more on 5-grams, one a class of equal sets."""
    return S.similar_pairs(S.shingled(_texts(spark, d), 5), 0.8).select("a", "b", F.round("similarity", 9).alias("similarity"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    near = S.similar_pairs(S.shingled(_texts(spark, d), 5), 0.5).select("a", "b", "cell")
    return S.scored_pairs(near, _texts(spark, d), 3)


def scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """X10, X12, PF9: directional scores on 3-grams of pairs of 0.5 or more on 5-grams."""
    ratio = [F.round(c, 9).alias(c) for c in ("jaccard", "containment", "a_in_b", "b_in_a", "length_ratio")]
    return _scored(spark, d).select("a", "b", *ratio, "shared", "only_a", "only_b", F.array_join("flags", ";").alias("flags"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of 0.5 or more on 5-grams, judged on these."""
    told = documents(spark, d, "text", "title", "original_url").withColumnRenamed("record_id", "doc_id")
    near = S.similar_pairs(S.shingled(_texts(spark, d), 5), 0.5).select("a", "b", "cell")
    return S.judged_pairs(near, told, 5, THRESHOLDS, RULE.preserved)


def pair_labels(spark: SparkSession, d: str) -> DataFrame:
    """PF10, PF11, PF12, PF13: what the scores and both records say about a pair, and why it may be worth a look."""
    return _judged(spark, d).select("a", "b", "label", F.array_join("categories", ";").alias("categories"), "action")


def policy_matrix(spark: SparkSession, d: str) -> DataFrame:
    """What four policies accept at 0.85."""
    return S.policy_matrix(_judged(spark, d))


def exact_tail_summary(spark: SparkSession, d: str) -> DataFrame:
    """Alike pairs by tail band, sources, hosts and containment."""
    return S.tail_summary(_judged(spark, d))


def review_pool(spark: SparkSession, d: str) -> DataFrame:
    """SM11, W11: pairs for people to read."""
    return S.review_pool(_judged(spark, d), F.sha2(F.concat(F.lit("review-v1\0"), "category", F.lit("\0"), "a", F.lit("\0"), "b"), 256))


def lsh_configurations(spark: SparkSession, d: str) -> DataFrame:
    """Every configuration of bands, with the chance that a pair of 0.85 shares one."""
    rows = spark.createDataFrame(CONFIGURATIONS, "config string, words int, permutations int, bands int, rows int")
    return rows.withColumn("found_at_85", F.round(1 - F.pow(1 - F.pow(F.lit(0.85), F.col("rows")), F.col("bands")), 6))


def distinctive_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores on n-grams of few documents."""
    near = S.similar_pairs(S.shingled(_texts(spark, d), 5), 0.8).select("a", "b", "cell")
    out = S.distinctive_scores(near, _texts(spark, d), 5, 3)
    return out.select("a", "b", *[F.round(c, 9).alias(c) for c in ("distinctive_jaccard", "distinctive_containment", "common_share")])


def _signatures(spark: SparkSession, d: str) -> DataFrame:
    return S.portable_signatures(_texts(spark, d), 5, PERMUTATIONS)


def minhash_signatures(spark: SparkSession, d: str) -> DataFrame:
    """Portable signatures; the sum of their values tells them apart."""
    total = F.aggregate("signature", F.lit(0).cast("long"), lambda s, x: s + x)
    return _signatures(spark, d).select("doc_id", F.size("signature").cast("long").alias("size"), total.alias("total"), F.element_at("signature", 1).alias("first"))


def bucket_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of buckets."""
    return S.bucket_metrics(S.bucket_postings(_signatures(spark, d), BANDS, ROWS))


def lsh_recall(spark: SparkSession, d: str) -> DataFrame:
    """What banding with 16 bands of 8 finds of the pairs that are alike, both among representatives of equal sets; signatures of the fast family."""
    sets = Workspace(spark).write(S.shingled(_texts(spark, d), 5))  # both sides choose their representatives from these
    reps = S.set_classes(sets).where(F.col("doc_id") == F.col("class_id")).select("doc_id")
    signed = S.shingle_sets(_texts(spark, d).join(reps, "doc_id", "left_semi"), 5, "doc_id").select("doc_id", fast_minhash("shingles", 128).alias("signature"))
    made = S.candidate_pairs(S.bucket_postings(signed, 16, 8))
    gold = S.scored_pairs(S.similar_pairs(sets, 0.5).select("a", "b", "cell"), _texts(spark, d), 5)
    return S.recall_table(gold, made, THRESHOLDS)


def minhash_error(spark: SparkSession, d: str) -> DataFrame:
    """Mean error of portable signatures on pairs that are alike."""
    gold = S.scored_pairs(S.similar_pairs(S.shingled(_texts(spark, d), 5), 0.5).select("a", "b", "cell"), _texts(spark, d), 5)
    out = S.estimate_error(gold.select("a", "b", "jaccard"), _signatures(spark, d))
    return out.select("a", "b", F.round("jaccard", 9).alias("jaccard"), F.round("estimated", 9).alias("estimated"))


QUERIES = {
    f.__name__: f
    for f in (
        merged_pairs, described_pairs, candidate_summary, candidate_summaries, pair_errors, source_pair_summary, pair_components, threshold_sweep, cluster_owners, pair_owners, review_panel, title_similarity,
        shingle_frequency, similar_pairs, scored_pairs, pair_labels, policy_matrix, exact_tail_summary, review_pool, lsh_configurations, distinctive_scores, minhash_signatures, bucket_metrics, lsh_recall, minhash_error,
    )
}

_MERGED = f"""merged AS (SELECT least(a, b) AS id_a, greatest(a, b) AS id_b, bit_or(config_mask) AS config_mask, sum(bucket_hits)::BIGINT AS bucket_hits, max(max_bucket_size) AS max_bucket_size,
    max(estimated_similarity) AS estimated_similarity FROM (SELECT {hex_sql("id_a")} AS a, {hex_sql("id_b")} AS b, * FROM pairs)
    WHERE a <> b AND estimated_similarity BETWEEN 0 AND 1 AND NOT isnan(estimated_similarity) GROUP BY 1, 2)"""


_DESCRIBED = f"""{REC}, {_MERGED}, ends AS (
    SELECT m.*, a.source AS sa, b.source AS sb, a.words AS wa, b.words AS wb, concat_ws('/', a.source, a.subset) AS ka, concat_ws('/', b.source, b.subset) AS kb
    FROM merged m JOIN rec a ON a.record_id = id_a JOIN rec b ON b.record_id = id_b),
lengths AS (SELECT *, CASE WHEN wa IS NULL OR wb IS NULL THEN NULL WHEN greatest(wa, wb) = 0 THEN 1.0 ELSE least(wa, wb) / greatest(wa, wb) END AS ratio FROM ends),
described AS (SELECT *,
    CASE WHEN estimated_similarity < 0.7 THEN 'lt0.70' WHEN estimated_similarity < 0.8 THEN '0.70_0.80' WHEN estimated_similarity < 0.85 THEN '0.80_0.85' WHEN estimated_similarity < 0.9 THEN '0.85_0.90'
        WHEN estimated_similarity < 0.92 THEN '0.90_0.92' WHEN estimated_similarity < 0.95 THEN '0.92_0.95' WHEN estimated_similarity IS NOT NULL THEN 'ge0.95' END AS similarity_band,
    CASE WHEN estimated_similarity < 0.8 THEN NULL WHEN estimated_similarity < 0.85 THEN '0.80_0.85' WHEN estimated_similarity < 0.9 THEN '0.85_0.90'
        WHEN estimated_similarity < 0.92 THEN '0.90_0.92' WHEN estimated_similarity < 0.95 THEN '0.92_0.95' WHEN estimated_similarity IS NOT NULL THEN 'ge0.95' END AS tail_band,
    CASE WHEN max_bucket_size < 2 THEN NULL WHEN max_bucket_size < 6 THEN '2_5' WHEN max_bucket_size < 21 THEN '6_20' WHEN max_bucket_size < 65 THEN '21_64'
        WHEN max_bucket_size < 257 THEN '65_256' WHEN max_bucket_size IS NOT NULL THEN 'gt256' END AS bucket_band,
    CASE WHEN least(wa, wb) < 20 THEN 'lt20' WHEN least(wa, wb) < 100 THEN '20_99' WHEN least(wa, wb) < 1000 THEN '100_999' WHEN least(wa, wb) < 100000 THEN '1000_99999'
        WHEN least(wa, wb) IS NOT NULL THEN 'ge100000' END AS length_band,
    CASE WHEN ratio < 0.1 THEN 'lt0.10' WHEN ratio < 0.25 THEN '0.10_0.25' WHEN ratio < 0.5 THEN '0.25_0.50' WHEN ratio < 0.75 THEN '0.50_0.75' WHEN ratio < 0.9 THEN '0.75_0.90'
        WHEN ratio IS NOT NULL THEN '0.90_1.00' END AS ratio_band,
    CASE WHEN sa IS NOT DISTINCT FROM sb THEN 'within_source' ELSE 'cross_source' END AS relation, least(ka, kb) || ' | ' || greatest(ka, kb) AS pair_key FROM lengths)"""


def _reach(least: float, name: str = "comp") -> str:
    return f"""link_{name} AS (SELECT id_a AS a, id_b AS b FROM merged WHERE estimated_similarity >= {least} UNION SELECT id_b, id_a FROM merged WHERE estimated_similarity >= {least}),
    reach_{name}(v, u) AS (SELECT a, b FROM link_{name} UNION SELECT r.v, l.b FROM reach_{name} r JOIN link_{name} l ON r.u = l.a),
    {name} AS (SELECT v AS id, min(u) AS component FROM reach_{name} GROUP BY v)"""


def _sweep() -> str:
    parts = []
    for i, t in enumerate(THRESHOLDS):
        parts.append(f"""SELECT {t}::DOUBLE AS threshold, (SELECT count(*) FROM merged WHERE estimated_similarity >= {t}) AS pairs, count(DISTINCT component) AS clusters, count(*) AS records,
            count(*) - count(DISTINCT component) AS surplus FROM comp{i}""")
    return f"WITH RECURSIVE {_MERGED}, " + ", ".join(_reach(t, f"comp{i}") for i, t in enumerate(THRESHOLDS)) + " ".join([" " + " UNION ALL ".join(parts)])


_CLAIM = f"""CASE WHEN source IN ('gutenbergpt', 'wikipediapt', 'carolina') THEN 0 WHEN source = 'gigaverbov2' THEN {SUBSET_TIER} ELSE 9 END AS tier,
    CASE source WHEN 'gutenbergpt' THEN 0 WHEN 'wikipediapt' THEN 1 WHEN 'carolina' THEN 2 WHEN 'gigaverbov2' THEN 3 ELSE 9 END AS place, -coalesce(words, 0) AS less"""
_W = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"


def _sets(n: int, name: str) -> str:
    return f"""w{name} AS (SELECT record_id AS doc_id, {_W} AS w FROM {ND[6:]}),
    {name} AS (SELECT doc_id, CASE WHEN len(w) >= {n} THEN list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' ')))
        ELSE ['short' || chr(0) || array_to_string(w, ' ')] END AS s FROM w{name} WHERE len(w) > 0)"""


def _near(least: float) -> str:
    """Pairs of representatives of equal sets, counted through an inverted index."""
    return f"""{_sets(5, "five")}, cls AS (SELECT min(doc_id) AS doc_id, list_sort(s) AS s FROM five GROUP BY list_sort(s)),
    post AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM cls),
    near AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) / (any_value(x.n) + any_value(y.n) - count(*)) AS similarity FROM post x JOIN post y ON x.g = y.g AND x.doc_id < y.doc_id
        GROUP BY 1, 2 HAVING count(*) / (any_value(x.n) + any_value(y.n) - count(*)) >= {least} - 1e-12)"""


_SCORED = f"""{_near(0.5)}, {_sets(3, "three")}, sc AS (
    SELECT a, b, len(list_intersect(x.s, y.s)) AS shared, len(x.s) AS nx, len(y.s) AS ny FROM near JOIN three x ON x.doc_id = a JOIN three y ON y.doc_id = b),
scored AS (SELECT a, b, shared, shared / (nx + ny - shared) AS jaccard, shared / least(nx, ny) AS containment, shared / nx AS a_in_b, shared / ny AS b_in_a, least(nx, ny) / greatest(nx, ny) AS length_ratio,
    nx - shared AS only_a, ny - shared AS only_b FROM sc)"""
_RARE = """f AS (SELECT g, count(*) AS n FROM (SELECT unnest(s) AS g FROM five) GROUP BY g),
each AS (SELECT doc_id, unnest(s) AS g FROM five WHERE doc_id IN (SELECT a FROM near UNION SELECT b FROM near)),
r AS (SELECT doc_id, coalesce(list(g) FILTER (WHERE n < 3), []) AS rare, list(g) AS every FROM each JOIN f USING (g) GROUP BY doc_id),
both_r AS (SELECT a, b, len(x.rare) AS na, len(y.rare) AS nb, len(list_intersect(x.rare, y.rare)) AS sr, len(list_intersect(x.every, y.every)) AS sh FROM near JOIN r x ON x.doc_id = a JOIN r y ON y.doc_id = b),
rare AS (SELECT a, b, CASE WHEN na + nb - sr > 0 THEN sr / (na + nb - sr) ELSE 0.0 END AS dj, CASE WHEN least(na, nb) > 0 THEN sr / least(na, nb) ELSE 0.0 END AS dc,
    CASE WHEN sh > 0 THEN (sh - sr) / sh ELSE 0.0 END AS common_share FROM both_r)"""
_URL_HOST = r"""nullif(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(
    regexp_extract(trim(original_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '^www\.', ''), '\.$', ''), '')"""
_TITLE_WORDS = r"regexp_extract_all(lower(coalesce(title, '')), '[\p{L}\p{N}_]+')"
_JUDGED = f"""WITH {_near(0.5)}, {_RARE}, info AS (SELECT record_id, source, words, lower(left(text, 300)) AS head, {_URL_HOST} AS host, list_distinct({_TITLE_WORDS}) AS t,
    CASE WHEN len({_TITLE_WORDS}) >= 3 AND length(array_to_string({_TITLE_WORDS}, ' ')) >= 12 THEN array_to_string({_TITLE_WORDS}, ' ') END AS full_title FROM {ND[6:]}),
sc5 AS (SELECT a, b, len(list_intersect(x.s, y.s)) AS shared, len(x.s) AS nx, len(y.s) AS ny FROM near JOIN five x ON x.doc_id = a JOIN five y ON y.doc_id = b),
joined AS (SELECT sc5.a, sc5.b, shared, shared / (nx + ny - shared) AS jaccard, shared / least(nx, ny) AS containment, shared / nx AS a_in_b, shared / ny AS b_in_a, dj, dc, common_share,
    x.source AS sa, y.source AS sb, x.words AS wa, y.words AS wb, x.host AS ha, y.host AS hb, CASE WHEN greatest(x.words, y.words) = 0 THEN 1.0 ELSE least(x.words, y.words) / greatest(x.words, y.words) END AS ratio,
    CASE WHEN len(x.t) > 0 AND len(y.t) > 0 THEN len(list_intersect(x.t, y.t)) / (len(x.t) + len(y.t) - len(list_intersect(x.t, y.t))) END AS titles, x.head <> y.head AS heads_differ,
    coalesce(x.full_title = y.full_title, false) OR coalesce(x.host = y.host, false) AS related, 'parlamentopt' IN (x.source, y.source) AS preserved
    FROM sc5 JOIN rare ON rare.a = sc5.a AND rare.b = sc5.b JOIN info x ON x.record_id = sc5.a JOIN info y ON y.record_id = sc5.b),
edge AS (SELECT DISTINCT a, b FROM (SELECT a, b, t, jaccard FROM joined, (SELECT unnest([0.8, 0.85, 0.9, 0.92, 0.95]::DOUBLE[]) AS t) QUALIFY row_number() OVER (PARTITION BY t ORDER BY round(abs(jaccard - t), 12), a, b) <= 8)),
flagged AS (SELECT joined.*, edge.a IS NOT NULL AS boundary, coalesce(jaccard >= 0.8 AND titles < 0.2 AND heads_differ, false) AS boilerplate,
    concat_ws(';', CASE WHEN containment >= 0.9 AND jaccard < 0.8 THEN 'high_containment' END, CASE WHEN containment >= 0.95 AND ratio < 0.5 THEN 'short_in_long' END,
        CASE WHEN shared >= 100 AND jaccard < 0.8 THEN 'large_overlap' END) AS flags FROM joined LEFT JOIN edge ON edge.a = joined.a AND edge.b = joined.b),
judged AS (SELECT *,
    CASE WHEN preserved THEN 'ambiguous' WHEN greatest(a_in_b, b_in_a) >= 0.9 AND jaccard < 0.5 THEN 'containment case' WHEN jaccard >= 0.75 AND (dj < 0.3 OR common_share >= 0.75) THEN 'boilerplate false positive'
        WHEN jaccard >= 0.9 AND ratio >= 0.7 AND dj >= 0.7 THEN 'true duplicate' WHEN jaccard >= 0.75 AND ratio >= 0.5 AND dj >= 0.5 THEN 'probable duplicate' WHEN related THEN 'related but distinct' ELSE 'ambiguous' END AS label,
    concat_ws(';', CASE WHEN boundary THEN 'similarity_boundary' END, CASE WHEN jaccard >= 0.8 THEN 'high_exact_jaccard' END, CASE WHEN sa IS DISTINCT FROM sb THEN 'cross_source' END,
        CASE WHEN ha = hb THEN 'same_domain' END, CASE WHEN boilerplate THEN 'boilerplate_suspect' END, CASE WHEN flags <> '' THEN 'containment' END,
        CASE WHEN sa IN ('carolina', 'wikipediapt', 'gutenbergpt') AND sb = 'gigaverbov2' OR sb IN ('carolina', 'wikipediapt', 'gutenbergpt') AND sa = 'gigaverbov2' THEN 'curated_web' END,
        CASE WHEN sa = 'gigaverbov2' AND sb = 'gigaverbov2' THEN 'web_web' END, CASE WHEN least(sa, sb) = 'carolina' AND greatest(sa, sb) = 'wikipediapt' THEN 'carolina_wikipedia' END,
        CASE WHEN least(sa, sb) = 'gigaverbov2' AND greatest(sa, sb) = 'gutenbergpt' THEN 'gutenberg_web' END, CASE WHEN least(wa, wb) < 20 THEN 'short_text' END,
        CASE WHEN greatest(wa, wb) >= 100000 THEN 'giant_document' END, CASE WHEN preserved THEN 'parlamento_diagnostic_only' END) AS categories,
    CASE WHEN preserved THEN 'preserve_all_diagnostic' WHEN least(wa, wb) < 20 THEN 'exact_only_or_diagnostic' WHEN least(wa, wb) < 100 THEN 'review_only' ELSE 'normal_candidate_generation' END AS action FROM flagged)"""
_MINIMA = ", ".join(f"list_min(list_transform(h, lambda x: (x * {a} + {b}) % {PRIME}))" for a, b in portable_coefficients(PERMUTATIONS))
_SIGNED = f"""{_sets(5, "five")}, hashed AS (SELECT doc_id, list_transform(s, lambda x: (('0x' || substr(sha256(x), 1, 8))::BIGINT) % {PRIME}) AS h FROM five),
signed AS (SELECT doc_id, [{_MINIMA}] AS sig FROM hashed)"""

SQL = {
    "merged_pairs": f"WITH {_MERGED} SELECT * FROM merged",
    "described_pairs": f"WITH {_DESCRIBED} SELECT id_a, id_b, similarity_band, tail_band, bucket_band, length_band, ratio_band, relation, pair_key, round(ratio, 9) AS length_ratio, concat_ws(';', CASE WHEN config_mask & 1 > 0 THEN 'word5_128_32x4' END, CASE WHEN config_mask & 2 > 0 THEN 'word5_128_8x16' END) AS configs, false AS removal_eligible FROM described",
    "candidate_summaries": f"""WITH {_DESCRIBED}, p AS (SELECT *, CASE WHEN coalesce(sa, '') = 'parlamentopt' OR coalesce(sb, '') = 'parlamentopt' THEN 'with_preserved' ELSE 'without_preserved' END AS part FROM described),
        v AS (SELECT id_a, id_b, estimated_similarity, 'source_subset' AS scope, ka AS value FROM p UNION ALL SELECT id_a, id_b, estimated_similarity, 'source_subset', kb FROM p WHERE kb IS DISTINCT FROM ka
            UNION ALL SELECT id_a, id_b, estimated_similarity, 'source', sa FROM p UNION ALL SELECT id_a, id_b, estimated_similarity, 'source', sb FROM p WHERE sb IS DISTINCT FROM sa
            UNION ALL SELECT id_a, id_b, estimated_similarity, 'pair_ratio', concat_ws(' : ', pair_key, ratio_band) FROM p UNION ALL SELECT id_a, id_b, estimated_similarity, 'similarity_partition_length', concat_ws(' : ', similarity_band, part, length_band) FROM p
            UNION ALL SELECT id_a, id_b, estimated_similarity, 'length', length_band FROM p UNION ALL SELECT id_a, id_b, estimated_similarity, 'ratio', ratio_band FROM p UNION ALL SELECT id_a, id_b, estimated_similarity, 'relation', relation FROM p),
        e AS (SELECT scope, value, count(DISTINCT id) AS records FROM (SELECT scope, value, id_a AS id FROM v UNION ALL SELECT scope, value, id_b FROM v) GROUP BY 1, 2)
        SELECT scope, value, count(*) AS pairs, round(avg(estimated_similarity), 9) AS mean_similarity, any_value(records) AS records FROM v JOIN e USING (scope, value) WHERE value IS NOT NULL GROUP BY 1, 2""",
    "pair_errors": f"""WITH {REC}, k AS (SELECT record_id FROM rec), p AS (SELECT {hex_sql("id_a")} AS a, {hex_sql("id_b")} AS b, * FROM pairs),
        e AS (SELECT CASE WHEN coalesce(a, '') = '' OR coalesce(b, '') = '' THEN 'id_missing' END AS error FROM p UNION ALL SELECT CASE WHEN a = b THEN 'record_with_itself' END FROM p
            UNION ALL SELECT CASE WHEN a > b THEN 'order_reversed' END FROM p UNION ALL SELECT CASE WHEN NOT coalesce(estimated_similarity BETWEEN 0 AND 1 AND NOT isnan(estimated_similarity), false) THEN 'similarity_unusable' END FROM p
            UNION ALL SELECT CASE WHEN a <> '' AND a NOT IN (SELECT record_id FROM k) OR b <> '' AND b NOT IN (SELECT record_id FROM k) THEN 'record_unknown' END FROM p
            UNION ALL SELECT CASE WHEN bucket_hits < 1 OR max_bucket_size < 2 OR config_mask < 1 THEN 'evidence_impossible' END FROM p
            UNION ALL SELECT CASE WHEN count(*) > 1 THEN 'pair_repeated' END FROM p GROUP BY least(a, b), greatest(a, b))
        SELECT error, count(*) AS rows FROM e WHERE error IS NOT NULL GROUP BY error""",
    "candidate_summary": f"""WITH {_DESCRIBED}, e AS (SELECT similarity_band, relation, id_a AS id FROM described UNION SELECT similarity_band, relation, id_b FROM described)
        SELECT similarity_band, relation, count(*) AS pairs, round(avg(estimated_similarity), 9) AS mean_similarity, any_value(n) AS records
        FROM described JOIN (SELECT similarity_band, relation, count(*) AS n FROM e GROUP BY 1, 2) USING (similarity_band, relation) GROUP BY 1, 2""",
    "source_pair_summary": f"""WITH {_DESCRIBED}, e AS (SELECT pair_key, ratio_band, id_a AS id FROM described UNION SELECT pair_key, ratio_band, id_b FROM described)
        SELECT pair_key, ratio_band, count(*) AS pairs, round(avg(estimated_similarity), 9) AS mean_similarity, any_value(n) AS records
        FROM described JOIN (SELECT pair_key, ratio_band, count(*) AS n FROM e GROUP BY 1, 2) USING (pair_key, ratio_band) GROUP BY 1, 2""",
    "pair_components": f"WITH RECURSIVE {_MERGED}, {_reach(0.85)} SELECT * FROM comp",
    "threshold_sweep": _sweep(),
    "cluster_owners": f"""WITH RECURSIVE {REC}, {_MERGED}, {_reach(0.85)}, m AS (SELECT component, record_id, {_CLAIM} FROM comp JOIN rec ON id = record_id)
        SELECT component, first(record_id ORDER BY tier, place, less, record_id) AS owner_id, count(*) AS members FROM m GROUP BY component""",
    "pair_owners": f"""WITH {REC}, {_MERGED}, r AS (SELECT record_id, source, original_url, subset, {_CLAIM} FROM rec),
        e AS (SELECT id_a, id_b, a.source = 'carolina' AND b.source = 'wikipediapt' AND (coalesce(contains(a.subset, 'wik'), false) OR coalesce(contains(lower(a.original_url), 'wikipedia'), false)) AS a_taken,
            b.source = 'carolina' AND a.source = 'wikipediapt' AND (coalesce(contains(b.subset, 'wik'), false) OR coalesce(contains(lower(b.original_url), 'wikipedia'), false)) AS b_taken,
            (a.tier, a.place, a.less, id_a) <= (b.tier, b.place, b.less, id_b) AS a_first FROM merged JOIN r a ON a.record_id = id_a JOIN r b ON b.record_id = id_b)
        SELECT id_a, id_b, CASE WHEN a_taken THEN id_b WHEN b_taken THEN id_a WHEN a_first THEN id_a ELSE id_b END AS owner_id FROM e""",
    "review_panel": f"""WITH {_MERGED}, n AS (SELECT id_a, id_b, estimated_similarity, t FROM merged, (SELECT unnest([{", ".join(map(str, THRESHOLDS))}]::DOUBLE[]) AS t)
            QUALIFY row_number() OVER (PARTITION BY t ORDER BY round(abs(estimated_similarity - t), 12), id_a, id_b) <= 8)
        SELECT id_a, id_b, estimated_similarity, string_agg(t::VARCHAR, ';' ORDER BY t) AS boundaries FROM n GROUP BY ALL""",
    "title_similarity": rf"""WITH {REC}, {_MERGED}, t AS (SELECT record_id, list_distinct(regexp_extract_all(lower(coalesce(title, '')), '[\p{{L}}\p{{N}}_]+')) AS t FROM rec)
        SELECT id_a, id_b, CASE WHEN len(a.t) + len(b.t) > 0 THEN round(len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))), 9) ELSE 0.0 END AS title_jaccard
        FROM merged JOIN t a ON a.record_id = id_a JOIN t b ON b.record_id = id_b""",
    "shingle_frequency": f"WITH {_sets(5, 'five')}, p AS (SELECT doc_id, unnest(s) AS g FROM five), f AS (SELECT g, count(*) AS n FROM p GROUP BY g) SELECT n AS documents, count(*) AS shingles FROM f GROUP BY n",
    "similar_pairs": f"WITH {_near(0.8)} SELECT a, b, round(similarity, 9) AS similarity FROM near",
    "scored_pairs": f"""WITH {_SCORED} SELECT a, b, round(jaccard, 9) AS jaccard, round(containment, 9) AS containment, round(a_in_b, 9) AS a_in_b, round(b_in_a, 9) AS b_in_a,
        round(length_ratio, 9) AS length_ratio, shared, only_a, only_b, concat_ws(';', CASE WHEN containment >= 0.9 AND jaccard < 0.8 THEN 'high_containment' END,
        CASE WHEN containment >= 0.95 AND length_ratio < 0.5 THEN 'short_in_long' END, CASE WHEN shared >= 100 AND jaccard < 0.8 THEN 'large_overlap' END) AS flags FROM scored""",
    "pair_labels": f"{_JUDGED} SELECT a, b, label, categories, action FROM judged",
    "policy_matrix": f"""{_JUDGED}, p AS (
        SELECT 'P1' AS policy, *, jaccard >= 0.85 AS passes, false AS told FROM judged UNION ALL SELECT 'P2', *, jaccard >= 0.85 AND least(wa, wb) >= 20, false FROM judged
        UNION ALL SELECT 'P3', *, jaccard >= 0.85 AND least(wa, wb) >= 20, true FROM judged UNION ALL SELECT 'P4', *, jaccard >= 0.85 AND least(wa, wb) >= 20 AND dj >= 0.75, true FROM judged),
        c AS (SELECT policy, count(*) FILTER (WHERE passes AND NOT preserved) AS accepted, count(*) FILTER (WHERE passes AND NOT preserved AND label IN ('true duplicate', 'probable duplicate')) AS duplicates,
            count(*) FILTER (WHERE jaccard >= 0.85) AS alike, count(*) FILTER (WHERE passes) AS alike_accepted, count(*) FILTER (WHERE told AND label = 'containment case') AS contained FROM p GROUP BY policy)
        SELECT *, round(duplicates / nullif(accepted, 0), 9) AS precision, round(alike_accepted / nullif(alike, 0), 9) AS recall FROM c""",
    "exact_tail_summary": f"""{_JUDGED}, t AS (SELECT *, CASE WHEN jaccard < 0.8 THEN NULL WHEN jaccard < 0.85 THEN '0.80_0.85' WHEN jaccard < 0.9 THEN '0.85_0.90' WHEN jaccard < 0.92 THEN '0.90_0.92'
            WHEN jaccard < 0.95 THEN '0.92_0.95' ELSE 'ge0.95' END AS tail, CASE WHEN preserved THEN 'with_preserved' ELSE 'without_preserved' END AS partition FROM judged),
        v AS (SELECT 'source_pair' AS scope, least(sa, sb) || ' | ' || greatest(sa, sb) AS value, tail, partition FROM t WHERE tail IS NOT NULL
            UNION ALL SELECT 'source', sa, tail, partition FROM t WHERE tail IS NOT NULL UNION ALL SELECT 'source', sb, tail, partition FROM t WHERE tail IS NOT NULL AND sa <> sb
            UNION ALL SELECT 'host', ha, tail, partition FROM t WHERE tail IS NOT NULL AND ha IS NOT NULL UNION ALL SELECT 'host', hb, tail, partition FROM t WHERE tail IS NOT NULL AND hb IS NOT NULL AND hb IS DISTINCT FROM ha
            UNION ALL SELECT 'containment_flag', unnest(string_split(flags, ';')), tail, partition FROM t WHERE flags <> '')
        SELECT scope, value, tail, partition, count(*) AS pairs FROM v GROUP BY ALL""",
    "review_pool": f"""{_JUDGED}, c AS (SELECT *, unnest(CASE WHEN categories = '' THEN ['uncategorized'] ELSE string_split(categories, ';') END) AS category FROM judged),
        k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY category ORDER BY sha256('review-v1' || chr(0) || category || chr(0) || a || chr(0) || b), a, b) <= 12),
        o AS (SELECT DISTINCT a, b, label, jaccard, CASE WHEN preserved THEN 0 WHEN least(sa, sb) = 'carolina' AND greatest(sa, sb) = 'wikipediapt' THEN 1 WHEN common_share >= 0.5 THEN 2
            WHEN greatest(a_in_b, b_in_a) >= 0.8 THEN 3 ELSE 4 END AS priority FROM k)
        SELECT a, b, priority, label FROM o ORDER BY priority, jaccard DESC, a, b LIMIT 100""",
    "lsh_configurations": """SELECT *, round(1 - power(1 - power(0.85, rows), bands), 6) AS found_at_85 FROM (VALUES ('word5_64_16x4', 5, 64, 16, 4), ('word5_64_8x8', 5, 64, 8, 8), ('word5_128_32x4', 5, 128, 32, 4),
        ('word5_128_16x8', 5, 128, 16, 8), ('word5_128_8x16', 5, 128, 8, 16), ('word5_256_32x8', 5, 256, 32, 8), ('word5_256_16x16', 5, 256, 16, 16), ('word5_256_8x32', 5, 256, 8, 32),
        ('word3_128_32x4', 3, 128, 32, 4), ('word7_128_32x4', 7, 128, 32, 4)) t(config, words, permutations, bands, rows)""",
    "distinctive_scores": f"WITH {_near(0.8)}, {_RARE} SELECT a, b, round(dj, 9) AS distinctive_jaccard, round(dc, 9) AS distinctive_containment, round(common_share, 9) AS common_share FROM rare",
    "minhash_signatures": f"""WITH {_SIGNED} SELECT doc_id, len(sig) AS size, list_sum(sig)::BIGINT AS total, sig[1] AS first FROM signed
        UNION ALL SELECT doc_id, NULL, NULL, NULL FROM wfive WHERE doc_id NOT IN (SELECT doc_id FROM signed)""",
    "bucket_metrics": f"""WITH {_SIGNED}, p AS (SELECT doc_id, unnest(range(0, {BANDS})) AS band, sig FROM signed),
        z AS (SELECT band, sig[band * {ROWS} + 1:band * {ROWS} + {ROWS}] AS k, count(*) AS size FROM p GROUP BY 1, 2 HAVING count(*) > 1)
        SELECT '{BANDS}x{ROWS}' AS config, count(*) AS buckets, sum(size)::BIGINT AS members, max(size) AS largest, quantile_disc(size, 0.5) AS p50, quantile_disc(size, 0.9) AS p90,
        sum(size * (size - 1) // 2)::BIGINT AS pairs FROM z""",
    "minhash_error": f"""WITH {_near(0.5)}, {_SIGNED.replace(_sets(5, "five") + ",", "")}
        SELECT a, b, round(similarity, 9) AS jaccard, round(len(list_filter(range(1, {PERMUTATIONS} + 1), lambda i: x.sig[i] = y.sig[i])) / {PERMUTATIONS}, 9) AS estimated
        FROM near JOIN signed x ON x.doc_id = a JOIN signed y ON y.doc_id = b""",
}
