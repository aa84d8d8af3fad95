"""Splits, samples, allocations and mixtures over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions.hashing import stable_rank
from ..functions.keys import hex_key, label_key
from ..functions.text import normalized_title
from ..functions.urls import canonical_url, url_host
from ..operators import mixture as M
from ..operators import relate as R
from ..operators import sampling as S
from ..operators import verify as V
from ..operators.current import bottom_k, latest_rows
from .base import REC, SEED, TRIM_SQL, hex_sql, key_sql, read, records

RANKS = {"split": "split-rank-v1", "sample": "sample-rank-v1"}


def _refs(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "refs").select(
        hex_key("doc_id").alias("doc_id"), hex_key("group_id").alias("group_id"), label_key("source").alias("source"), "subset", "domain_category", "source_shard",
        "source_row_ordinal", "normalized_words", "is_long", "loaded_at",
    )
    return latest_rows(rows, ["doc_id"], "loaded_at", ["group_id"])


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "candidate").select(
        hex_key("doc_id").alias("doc_id"), label_key("sample_bucket").alias("bucket"), F.col("normalized_words").alias("words"), "subset", "source_shard", "source_row_ordinal",
        "source_row_group", "seen_at",
    )
    return latest_rows(rows, ["doc_id"], "seen_at", ["bucket"])


def _targets(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "quota_plan").select(label_key("sample_bucket").alias("bucket"), "target_words", "share_bp")


def split_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Splits of groups by rank within source and subset."""
    return S.split_groups(_refs(spark, d).select("group_id", "source", "subset").groupBy("group_id").agg(F.min("source").alias("source"), F.min("subset").alias("subset")), SEED)


def split_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Documents and words of each split by source."""
    rows = _refs(spark, d).drop("source", "subset").join(split_assignments(spark, d), "group_id")
    return rows.groupBy("source", "split").agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("group_id").alias("groups"), F.sum("normalized_words").alias("words"), F.count_if("is_long").alias("long_documents")
    )


def split_check(spark: SparkSession, d: str) -> DataFrame:
    """V3, V8: what the check finds in splits damaged on purpose: ranks from 0... lost their split, ranks from 1... have a second one."""
    groups = _refs(spark, d).groupBy("group_id").agg(F.min("source").alias("source"), F.min("subset").alias("subset"))
    made = S.split_groups(groups, SEED)
    lost = made.withColumn("split", F.when(F.col("rank_hash").startswith("0"), "lost").otherwise(F.col("split")))
    second = made.where(F.col("rank_hash").startswith("1")).withColumn("split", F.when(F.col("split") == "train", "test").otherwise("train"))
    return V.verify_splits(lost.unionByName(second), groups, SEED)


def bottom_k_per_stratum(spark: SparkSession, d: str) -> DataFrame:
    """W4, SM8: the 32 documents of smallest rank of each source and domain."""
    rows = _refs(spark, d).select("doc_id", "source", F.coalesce("domain_category", F.lit("unknown")).alias("domain"), stable_rank(RANKS["sample"], SEED, "doc_id").alias("rank"))
    return bottom_k(rows, ["source", "domain"], "rank", "doc_id", 32).select("doc_id", "source", "domain")


def reservoir_sample(spark: SparkSession, d: str) -> DataFrame:
    """SM1, SM2: stratified reservoirs by xxh64."""
    return S.reservoir(_refs(spark, d).select("doc_id", "source"), "doc_id", 20, ["source"])


def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    """SM3: 10,000 documents shared out by the subsets' numbers of documents."""
    sizes = _refs(spark, d).groupBy("subset").agg(F.count(F.lit(1)).alias("n"))
    return S.largest_remainder(sizes, "subset", "n", 10_000)


def quota_words(spark: SparkSession, d: str) -> DataFrame:
    """SM5: words a bucket of a sample of a million words by basis points."""
    return _targets(spark, d).select("bucket", (F.col("share_bp") * 100).cast("long").alias("words"))


def greedy_quota_sample(spark: SparkSession, d: str) -> DataFrame:
    """SM6: whole documents fitted into the targets in rank order."""
    return S.greedy_fit(_candidates(spark, d), _targets(spark, d), SEED).select("doc_id", "bucket", "words")


def quota_report(spark: SparkSession, d: str) -> DataFrame:
    """How far the fitted sample meets its targets."""
    return S.quota_report(S.greedy_fit(_candidates(spark, d), _targets(spark, d), SEED), _targets(spark, d))


def sample_check(spark: SparkSession, d: str) -> DataFrame:
    """V4: what the check finds in a fitted sample damaged on purpose: ranks from 0... are missing, ranks from 1... are there twice."""
    c, t = _candidates(spark, d), _targets(spark, d)
    made = S.greedy_fit(c, t, SEED)
    return V.verify_sample(made.where(~F.col("rank_hash").startswith("0")).unionByName(made.where(F.col("rank_hash").startswith("1"))), c, t, SEED)


def frame_groups(spark: SparkSession, d: str) -> DataFrame:
    """Row groups in rank order until a bucket's words reach ten times its target."""
    rows = _candidates(spark, d).where((F.col("words") > 0) & F.col("bucket").isNotNull())
    rows = rows.withColumn("piece", F.concat_ws(":", "source_shard", F.col("source_row_group").cast("string")))
    groups = rows.groupBy("bucket", "piece").agg(F.sum("words").alias("words")).withColumn("rank", stable_rank("frame-rank-v1", SEED, F.concat_ws("|", "bucket", "piece")))
    groups = groups.join(_targets(spark, d), "bucket")
    return S.frame(groups, ["bucket"], "rank", "piece", "words", F.col("target_words") * 10).select("bucket", "piece", "words", "words_before")


def frame_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents that lie in the frame, by bucket, shard and row group."""
    rows = _candidates(spark, d).withColumn("piece", F.concat_ws(":", "source_shard", F.col("source_row_group").cast("string")))
    return rows.where(F.col("words") > 0).join(frame_groups(spark, d).select("bucket", "piece"), ["bucket", "piece"], "left_semi").select("doc_id", "bucket", "piece", "words")


def reference_differences(spark: SparkSession, d: str) -> DataFrame:
    """PF19, PF20: references against the records they name, field by field: compared rows and how many differ (NULL equals NULL); and references without a record."""
    r = latest_rows(
        read(spark, d, "refs").select(hex_key("doc_id").alias("doc_id"), label_key("source").alias("source"), label_key("subset").alias("subset"), label_key("original_id").alias("original_id"),
                                      hex_key("content_sha256").alias("content_sha256"), F.col("normalized_words").alias("words"), "loaded_at"), ["doc_id"], "loaded_at", ["content_sha256"])
    known = records(spark, d, label_key("original_id").alias("original_key")).select("record_id", "source", "subset", F.col("original_key").alias("original_id"), "content_sha256", "words")
    return R.field_differences(r.drop("loaded_at"), known.withColumnRenamed("record_id", "doc_id"), "doc_id", ("source", "subset", "original_id", "content_sha256", "words"))


def assignment_errors(spark: SparkSession, d: str) -> DataFrame:
    """PF18: which rules rows of split_groups break, and how often."""
    rows = read(spark, d, "split_groups").select("group_id", label_key("split").alias("split"), hex_key("rank_hash").alias("rank_hash"), "assigned_at")
    return V.assignment_errors(rows, _refs(spark, d).select("group_id").distinct())


def late_texts(spark: SparkSession, d: str) -> DataFrame:
    """J20, SM7: from the fitted sample back to the records and texts it stands for; texts are read for chosen rows alone and checked by their hash."""
    texts = read(spark, d, "normalized_document").select(hex_key("record_id").alias("doc_id"), "text", hex_key("content_sha256").alias("told"), "loaded_at")
    return R.late_texts(greedy_quota_sample(spark, d).select("doc_id", "bucket"), texts, "doc_id", "loaded_at", "told")


def neighbour_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Documents that follow one another in a row group."""
    return S.neighbours(_candidates(spark, d), ["subset", "source_shard", "source_row_group"], "source_row_ordinal", "doc_id")


def circular_pick(spark: SparkSession, d: str) -> DataFrame:
    """Forty documents from a pivot on."""
    return S.circular_pick(_refs(spark, d).select("doc_id"), "doc_id", "f8", 400)


def round_robin_order(spark: SparkSession, d: str) -> DataFrame:
    """An order that visits the subsets in turns."""
    rows = _refs(spark, d).select("doc_id", F.coalesce("subset", F.lit("")).alias("subset"), stable_rank(RANKS["sample"], SEED, "doc_id").alias("rank"))
    return S.round_robin(rows, "subset", "rank", "doc_id").select("doc_id", "subset", "turn")


def stratified_pilot(spark: SparkSession, d: str) -> DataFrame:
    """A pilot of 300 documents over length strata."""
    rows = records(spark, d).select("record_id", B.length_stratum("words").alias("stratum"), stable_rank(RANKS["sample"], SEED, "record_id").alias("rank"))
    return S.stratified_pilot(rows, "stratum", "rank", "record_id", 300).select("record_id", "stratum")


def marginal_sample(spark: SparkSession, d: str) -> DataFrame:
    """SM10: bottom 24 of every source, domain and length band, together."""
    rows = _refs(spark, d).select("doc_id", "source", "domain_category", "normalized_words", stable_rank(RANKS["sample"], SEED, "doc_id").alias("rank"))
    strata = {"source": F.col("source"), "domain": F.col("domain_category"), "length": B.length_band("normalized_words")}
    out = S.multi_stratum(rows, strata, dict.fromkeys(strata, 24), "rank", "doc_id")
    return out.select("doc_id", F.array_join("strata", ";").alias("strata"))


def metadata_families(spark: SparkSession, d: str) -> DataFrame:
    """SM9: documents that share a title, a URL or a host, eight of each family."""
    docs = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "title", "original_url")
    docs = docs.withColumn("rank", stable_rank(RANKS["sample"], SEED, "doc_id"))
    kinds = {"title": normalized_title("title"), "url": canonical_url("original_url"), "host": url_host("original_url")}
    out = None
    for kind, family in kinds.items():
        part = S.families(docs, kind, family, "doc_id", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def mixture_capacity(spark: SparkSession, d: str) -> DataFrame:
    """A10: what the mix plan's shares allow with the words at hand."""
    words = _refs(spark, d).select(F.when(F.col("source") == "gigaverbov2", F.concat("source", label_key("subset"))).otherwise(F.col("source")).alias("key"), "normalized_words")
    have = words.groupBy("key").agg(F.sum("normalized_words").alias("available"))
    plan = read(spark, d, "mix_plan").select("component", label_key("component").alias("key"), "share_bp")
    return M.capacity(plan.join(have, "key", "left"))


def row_group_of(spark: SparkSession, d: str) -> DataFrame:
    """The row group that holds each row ordinal, by the last group that starts at or before it."""
    c = _candidates(spark, d).where(F.col("source_row_group").isNotNull())
    starts = c.groupBy("source_shard", "source_row_group").agg(F.min("source_row_ordinal").alias("start"))
    points = _refs(spark, d).select("doc_id", "source_shard", "source_row_ordinal")
    return R.containing_range(points, starts, ["source_shard"], "source_row_ordinal", "start", ["source_row_group"], 500)


def left_over(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the plan's buckets that the fitted sample did not take."""
    c = _candidates(spark, d).where(F.col("words") > 0).join(_targets(spark, d).select("bucket"), "bucket", "left_semi")
    return c.join(greedy_quota_sample(spark, d), "doc_id", "left_anti").groupBy("bucket").agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"))


def occurrence_match(spark: SparkSession, d: str) -> DataFrame:
    """The k-th delivery of a record in one table with its k-th delivery in the other."""
    a = read(spark, d, "normalized_document").select(hex_key("record_id").alias("record_id"), F.col("loaded_at").alias("text_at"))
    b = read(spark, d, "records").select(hex_key("record_id").alias("record_id"), F.col("loaded_at").alias("record_at"), F.col("normalized_words").alias("words"))
    return R.kth_with_kth(a, b, ["record_id"], ["text_at"], ["record_at", "words"], ["record_at", "words"]).select("record_id", "text_at", "record_at", "words")


QUERIES = {
    f.__name__: f
    for f in (
        split_assignments, split_accounting, split_check, bottom_k_per_stratum, reservoir_sample, largest_remainder, quota_words, greedy_quota_sample, quota_report, sample_check,
        frame_groups, frame_documents, reference_differences, assignment_errors, late_texts, neighbour_pairs, circular_pick, round_robin_order, stratified_pilot, marginal_sample, metadata_families, mixture_capacity, row_group_of, left_over, occurrence_match,
    )
}

_REFS = f"""refs1 AS (SELECT {hex_sql("doc_id")} AS doc_id, {hex_sql("group_id")} AS group_id, {key_sql("source")} AS source, * EXCLUDE (doc_id, group_id, source) FROM refs
    QUALIFY row_number() OVER (PARTITION BY {hex_sql("refs.doc_id")} ORDER BY loaded_at DESC NULLS LAST, {hex_sql("refs.group_id")} DESC) = 1)"""
_CAND = f"""cand AS (SELECT {hex_sql("doc_id")} AS doc_id, {key_sql("sample_bucket")} AS bucket, normalized_words AS words, * EXCLUDE (doc_id, normalized_words) FROM candidate
    QUALIFY row_number() OVER (PARTITION BY {hex_sql("candidate.doc_id")} ORDER BY seen_at DESC NULLS LAST, {key_sql("sample_bucket")} DESC NULLS LAST) = 1)"""
_TARGET = f"target AS (SELECT {key_sql('sample_bucket')} AS bucket, target_words, share_bp FROM quota_plan)"


def _rank(kind: str, key: str) -> str:
    return f"sha256('{kind}' || chr(0) || '{SEED}' || chr(0) || {key})"


_SPLIT = f"""{_REFS}, g AS (SELECT group_id, coalesce(min(source), '') AS source, coalesce(min(subset), '') AS subset, {_rank(RANKS["split"], "group_id")} AS rank_hash FROM refs1 GROUP BY group_id),
p AS (SELECT *, row_number() OVER (PARTITION BY source, subset ORDER BY rank_hash, group_id) AS place, count(*) OVER (PARTITION BY source, subset) AS n FROM g),
h AS (SELECT *, CASE WHEN n <= 1 THEN 0 ELSE (n + 99) // 100 END AS h FROM p),
split AS (SELECT group_id, source, subset, rank_hash, place,
    CASE WHEN place <= CASE WHEN n = 2 THEN 0 ELSE h END THEN 'test' WHEN place <= CASE WHEN n = 2 THEN 0 ELSE h END + h THEN 'validation' ELSE 'train' END AS split FROM h)"""
_GREEDY = f"""{_CAND}, {_TARGET},
q AS (SELECT bucket, doc_id, words, target_words, row_number() OVER (PARTITION BY bucket ORDER BY {_rank(RANKS["sample"], "doc_id")}, doc_id) AS i
    FROM cand JOIN target USING (bucket) WHERE words > 0),
step(bucket, i, room, doc_id, words, taken) AS (
    SELECT bucket, 0::BIGINT, target_words, NULL::VARCHAR, NULL::BIGINT, false FROM target
    UNION ALL
    SELECT q.bucket, q.i, CASE WHEN q.words <= room THEN room - q.words ELSE room END, q.doc_id, q.words, q.words <= room FROM step JOIN q ON q.bucket = step.bucket AND q.i = step.i + 1),
greedy AS (SELECT doc_id, bucket, words FROM step WHERE taken)"""
_SIZES = f"{_REFS}, s AS (SELECT subset, count(*) AS n FROM refs1 GROUP BY subset), b AS (SELECT subset, n * 10000 // sum(n) OVER () AS base, n * 10000 % sum(n) OVER () AS rest FROM s)"
_HOST = r"""nullif(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(
    regexp_extract(trim(original_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '^www\.', ''), '\.$', ''), '')"""
_PATH = r"""regexp_replace(regexp_replace(regexp_extract(trim(original_url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g'), '/$', '')"""
_TITLE = r"regexp_extract_all(lower(coalesce(title, '')), '[\p{L}\p{N}_]+')"
_BAND = "CASE WHEN normalized_words < 20 THEN 'lt20' WHEN normalized_words < 100 THEN '20_99' WHEN normalized_words < 1000 THEN '100_999' WHEN normalized_words < 100000 THEN '1000_99999' WHEN normalized_words IS NOT NULL THEN 'ge100000' END"

SQL = {
    "split_assignments": f"WITH {_SPLIT} SELECT * FROM split",
    "split_accounting": f"""WITH {_SPLIT} SELECT split.source, split, count(*) AS documents, count(DISTINCT group_id) AS groups, sum(normalized_words)::BIGINT AS words,
        count(*) FILTER (WHERE is_long) AS long_documents FROM refs1 JOIN split USING (group_id) GROUP BY 1, 2""",
    "split_check": f"""WITH {_SPLIT}, n AS (SELECT count(*) FILTER (WHERE starts_with(rank_hash, '0')) AS lost, count(*) FILTER (WHERE starts_with(rank_hash, '1')) AS twice FROM split)
        SELECT unnest(['differs_from_rebuild', 'unknown_split', 'group_in_two_splits']) AS check, unnest([2 * lost + twice, lost, twice]) AS n FROM n""",
    "bottom_k_per_stratum": f"""WITH {_REFS} SELECT doc_id, source, coalesce(domain_category, 'unknown') AS domain FROM refs1
        QUALIFY row_number() OVER (PARTITION BY source, coalesce(domain_category, 'unknown') ORDER BY {_rank(RANKS["sample"], "doc_id")}, doc_id) <= 32""",
    "largest_remainder": f"WITH {_SIZES} SELECT subset, (base + CASE WHEN row_number() OVER (ORDER BY rest DESC, subset) <= 10000 - sum(base) OVER () THEN 1 ELSE 0 END)::BIGINT AS allocated FROM b",
    "quota_words": f"WITH {_TARGET} SELECT bucket, share_bp::BIGINT * 100 AS words FROM target",
    "greedy_quota_sample": f"WITH RECURSIVE {_GREEDY} SELECT * FROM greedy",
    "quota_report": f"""WITH RECURSIVE {_GREEDY}, r AS (SELECT bucket, target_words, coalesce(sum(words), 0)::BIGINT AS actual_words, count(words) AS documents
        FROM target LEFT JOIN greedy USING (bucket) GROUP BY bucket, target_words),
        s AS (SELECT bucket, CASE WHEN grouping(bucket) = 1 THEN 'total' ELSE 'bucket' END AS scope, sum(target_words)::BIGINT AS target_words, sum(actual_words)::BIGINT AS actual_words, sum(documents)::BIGINT AS documents
        FROM r GROUP BY GROUPING SETS ((bucket), ()))
        SELECT *, actual_words - target_words AS deviation, coalesce((target_words - actual_words) * 10000 // nullif(target_words, 0), 0) AS shortfall_bp,
        CASE WHEN abs(coalesce((target_words - actual_words) * 10000 // nullif(target_words, 0), 0)) <= 100 THEN 'PASS' ELSE 'FAIL' END AS status FROM s""",
    "sample_check": f"""WITH RECURSIVE {_GREEDY}, r AS (SELECT bucket, words, left({_rank(RANKS["sample"], "doc_id")}, 1) AS c FROM greedy),
        over_target AS (SELECT bucket FROM r JOIN target USING (bucket) GROUP BY bucket, target_words HAVING sum(CASE c WHEN '0' THEN 0 WHEN '1' THEN 2 * words ELSE words END) > target_words),
        n AS (SELECT 'differs_from_rebuild' AS check, (SELECT count(*) FROM r WHERE c IN ('0', '1')) AS n UNION ALL SELECT 'bucket_above_target', (SELECT count(*) FROM over_target))
        SELECT * FROM n WHERE n > 0""",
    "frame_groups": f"""WITH {_CAND}, {_TARGET}, g AS (SELECT bucket, concat_ws(':', source_shard, source_row_group::VARCHAR) AS piece, sum(words)::BIGINT AS words FROM cand WHERE words > 0 AND bucket IS NOT NULL GROUP BY 1, 2),
        r AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY bucket ORDER BY {_rank("frame-rank-v1", "concat_ws('|', bucket, piece)")}, piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS words_before FROM g)
        SELECT bucket, piece, words, words_before FROM r JOIN target USING (bucket) WHERE words_before < target_words * 10""",
    "frame_documents": f"""WITH {_CAND}, {_TARGET}, p AS (SELECT *, concat_ws(':', source_shard, source_row_group::VARCHAR) AS piece FROM cand WHERE words > 0 AND bucket IS NOT NULL),
        g AS (SELECT bucket, piece, sum(words) AS words FROM p GROUP BY 1, 2),
        r AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY bucket ORDER BY {_rank("frame-rank-v1", "concat_ws('|', bucket, piece)")}, piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before FROM g)
        SELECT doc_id, bucket, piece, words FROM p WHERE (bucket, piece) IN (SELECT (bucket, piece) FROM r JOIN target USING (bucket) WHERE words_before < target_words * 10)""",
    "reference_differences": f"""WITH {REC}, f AS (SELECT {hex_sql("doc_id")} AS doc_id, {key_sql("source")} AS source, {key_sql("subset")} AS subset, {key_sql("original_id")} AS original_id,
            {hex_sql("content_sha256")} AS content_sha256, normalized_words AS words FROM refs
            QUALIFY row_number() OVER (PARTITION BY {hex_sql("refs.doc_id")} ORDER BY loaded_at DESC NULLS LAST, {hex_sql("refs.content_sha256")} DESC NULLS LAST) = 1),
        j AS (SELECT f.*, r.record_id, r.source AS source2, r.subset AS subset2, {key_sql("r.original_id")} AS original_id2, r.content_sha256 AS content2, r.words AS words2 FROM f LEFT JOIN rec r ON r.record_id = f.doc_id)
        SELECT 'no_record' AS field, count(*) AS compared, count(*) FILTER (WHERE record_id IS NULL) AS differing FROM j
        UNION ALL SELECT 'source', count(*), count(*) FILTER (WHERE source IS DISTINCT FROM source2) FROM j WHERE record_id IS NOT NULL
        UNION ALL SELECT 'subset', count(*), count(*) FILTER (WHERE subset IS DISTINCT FROM subset2) FROM j WHERE record_id IS NOT NULL
        UNION ALL SELECT 'original_id', count(*), count(*) FILTER (WHERE original_id IS DISTINCT FROM original_id2) FROM j WHERE record_id IS NOT NULL
        UNION ALL SELECT 'content_sha256', count(*), count(*) FILTER (WHERE content_sha256 IS DISTINCT FROM content2) FROM j WHERE record_id IS NOT NULL
        UNION ALL SELECT 'words', count(*), count(*) FILTER (WHERE words IS DISTINCT FROM words2) FROM j WHERE record_id IS NOT NULL""",
    "assignment_errors": f"""WITH {_REFS}, a AS (SELECT {hex_sql("group_id")} AS g, group_id, {key_sql("split")} AS split, {hex_sql("rank_hash")} AS rank_hash, assigned_at FROM split_groups),
        e AS (SELECT CASE WHEN coalesce(g, '') = '' THEN 'group_missing' END AS error FROM a UNION ALL SELECT CASE WHEN group_id <> g THEN 'group_spelled_unevenly' END FROM a
            UNION ALL SELECT CASE WHEN coalesce(split, '') NOT IN ('train', 'validation', 'test') THEN 'split_unknown' END FROM a
            UNION ALL SELECT CASE WHEN rank_hash IS NULL OR NOT regexp_full_match(rank_hash, '[0-9a-f]{{64}}') THEN 'rank_malformed' END FROM a
            UNION ALL SELECT CASE WHEN g <> '' AND g NOT IN (SELECT group_id FROM refs1 WHERE group_id IS NOT NULL) THEN 'group_not_in_refs' END FROM a
            UNION ALL SELECT CASE WHEN count(DISTINCT split) > 1 THEN 'group_in_two_splits' END FROM a WHERE g <> '' GROUP BY g)
        SELECT error, count(*) AS rows FROM e WHERE error IS NOT NULL GROUP BY error""",
    "late_texts": f"""WITH RECURSIVE {_GREEDY}, t AS (SELECT {hex_sql("record_id")} AS doc_id, text, {hex_sql("content_sha256")} AS told FROM normalized_document
            QUALIFY row_number() OVER (PARTITION BY {hex_sql("normalized_document.record_id")} ORDER BY loaded_at DESC NULLS LAST) = 1),
        n AS (SELECT doc_id, told, trim(nfc_normalize(regexp_replace(text, '\\r\\n?', chr(10), 'g')), {TRIM_SQL}) AS x FROM t)
        SELECT doc_id, bucket, coalesce(length(x), 0) AS characters, CASE WHEN x <> '' THEN sha256(x) END IS NOT DISTINCT FROM told AS hash_right FROM greedy JOIN n USING (doc_id)""",
    "neighbour_pairs": f"""WITH {_CAND}, n AS (SELECT subset, source_shard, source_row_group, lag(doc_id) OVER (PARTITION BY subset, source_shard, source_row_group ORDER BY source_row_ordinal, doc_id) AS doc_id_before, doc_id FROM cand)
        SELECT * FROM n WHERE doc_id_before IS NOT NULL""",
    "circular_pick": f"WITH {_REFS} SELECT doc_id FROM refs1 ORDER BY doc_id < 'f8', doc_id LIMIT 400",
    "round_robin_order": f"""WITH {_REFS} SELECT doc_id, coalesce(subset, '') AS subset, row_number() OVER (PARTITION BY coalesce(subset, '') ORDER BY {_rank(RANKS["sample"], "doc_id")}, doc_id) AS turn FROM refs1""",
    "stratified_pilot": f"""WITH {REC}, s AS (SELECT record_id, {_rank(RANKS["sample"], "record_id")} AS rank,
        CASE WHEN words < 20 THEN 'short' WHEN words < 1000 THEN 'medium' WHEN words < 100000 THEN 'long' WHEN words IS NOT NULL THEN 'giant' END AS stratum FROM rec),
        n AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY rank, record_id) <= CASE stratum WHEN 'short' THEN 60 WHEN 'long' THEN 30 WHEN 'medium' THEN 210 ELSE 0 END AS first FROM s WHERE stratum IS NOT NULL)
        SELECT record_id, stratum FROM n ORDER BY NOT first, rank, record_id LIMIT 300""",
    "marginal_sample": f"""WITH {_REFS}, t AS (SELECT doc_id, 'source' AS name, source AS value FROM refs1 UNION ALL SELECT doc_id, 'domain', domain_category FROM refs1 UNION ALL SELECT doc_id, 'length', {_BAND} FROM refs1),
        k AS (SELECT * FROM t WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name, value ORDER BY {_rank(RANKS["sample"], "doc_id")}, doc_id) <= 24)
        SELECT doc_id, string_agg(name || '=' || value, ';' ORDER BY name || '=' || value) AS strata FROM k GROUP BY doc_id""",
    "metadata_families": f"""WITH d AS (SELECT doc_id::VARCHAR AS member, {_HOST} AS host, {_HOST} || {_PATH} AS url,
            CASE WHEN len({_TITLE}) >= 3 AND length(array_to_string({_TITLE}, ' ')) >= 12 THEN array_to_string({_TITLE}, ' ') END AS title FROM documents),
        f AS (SELECT 'title' AS kind, title AS family, member FROM d UNION ALL SELECT 'url', url, member FROM d UNION ALL SELECT 'host', host, member FROM d),
        n AS (SELECT *, count(*) OVER (PARTITION BY kind, family) AS size, row_number() OVER (PARTITION BY kind, family ORDER BY {_rank(RANKS["sample"], "member")}, member) AS i FROM f WHERE family IS NOT NULL)
        SELECT kind, family, member, size FROM n WHERE size > 1 AND i <= 8""",
    "mixture_capacity": f"""WITH {_REFS}, w AS (SELECT CASE WHEN source = 'gigaverbov2' THEN source || {key_sql("subset")} ELSE source END AS k, sum(normalized_words)::BIGINT AS available FROM refs1 GROUP BY 1),
        c AS (SELECT component, coalesce(available, 0) AS available, share_bp::BIGINT AS share_bp, coalesce(available, 0) * 10000 // nullif(share_bp, 0) AS allows FROM mix_plan LEFT JOIN w ON k = {key_sql("component")})
        SELECT *, min(allows) OVER () AS capacity, allows = min(allows) OVER () AS limits, max(allows) OVER () * share_bp // nullif(available, 0) AS repeats_bp FROM c""",
    "row_group_of": f"""WITH {_REFS}, {_CAND}, s AS (SELECT source_shard, source_row_group, min(source_row_ordinal) AS start FROM cand WHERE source_row_group IS NOT NULL GROUP BY 1, 2)
        SELECT doc_id, refs1.source_shard, source_row_ordinal, source_row_group FROM refs1 ASOF LEFT JOIN s ON refs1.source_shard = s.source_shard AND source_row_ordinal >= start""",
    "left_over": f"""WITH RECURSIVE {_GREEDY} SELECT bucket, count(*) AS documents, sum(words)::BIGINT AS words FROM cand
        WHERE words > 0 AND bucket IN (SELECT bucket FROM target) AND doc_id NOT IN (SELECT doc_id FROM greedy) GROUP BY bucket""",
    "occurrence_match": f"""WITH a AS (SELECT {hex_sql("record_id")} AS record_id, loaded_at AS text_at, row_number() OVER (PARTITION BY {hex_sql("record_id")} ORDER BY loaded_at) AS k FROM normalized_document),
        b AS (SELECT {hex_sql("record_id")} AS record_id, loaded_at AS record_at, normalized_words AS words, row_number() OVER (PARTITION BY {hex_sql("record_id")} ORDER BY loaded_at, normalized_words) AS k FROM records)
        SELECT record_id, text_at, record_at, words FROM a JOIN b USING (record_id, k)""",
}
