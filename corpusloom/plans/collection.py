"""Normalization, profiles and exact duplicates over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions.text import content_hash, lines, normalized_text, repeated_line_ratio, word_count
from ..functions.urls import canonical_url, url_host
from ..operators import exact_dedup as D
from ..operators import normalize as N
from ..operators import profile as P
from .base import ND, REC, RESOLVED, RULE, TRIM_SQL, WEB, documents, filled_sql, read, records, web, words_sql

#: Every column of a normalized document but the text and the source it is grouped by.
FIELDS = (
    "source_revision", "subset", "original_id", "original_url", "license", "language", "language_score", "variety", "quality_score", "publication_date", "domain_category", "content_sha256",
    "title", "raw_source_file", "raw_record_identifier", "normalization_version", "_gv2_upstream_shard", "_gv2_upstream_row_group", "_gv2_upstream_commit", "upstream_metadata_json",
)
BLOCKED = ("culturax", "hplt1")
PATTERNS = (("web_crawl", ("*crawl*", "mc4*")), ("blog", ("blog?et",)), ("common", ("[op]*r*",)))


def normalized_texts(spark: SparkSession, d: str) -> DataFrame:
    """PF2: hash, words and characters of the normalized text."""
    docs = read(spark, d, "documents").select("doc_id", normalized_text("text").alias("t"), content_hash("text").alias("content_sha256"))
    return docs.select("doc_id", "content_sha256", word_count("t").alias("words"), F.coalesce(F.length("t"), F.lit(0)).cast("long").alias("characters"))


def contract_errors(spark: SparkSession, d: str) -> DataFrame:
    """PF3: which rules of a normalized row are broken, and how often."""
    return N.error_counts(read(spark, d, "normalized_document"))


def normalize_rejects(spark: SparkSession, d: str) -> DataFrame:
    """PF1: accepted and rejected records with their reasons."""
    good, bad = N.normalize_records(read(spark, d, "normalized_document"))
    told = bad.groupBy(F.array_join("reasons", ",").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
    return good.groupBy(F.lit("accepted").alias("outcome")).agg(F.count(F.lit(1)).alias("rows")).unionByName(told)


def subset_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """PF4: documents by subset and the rule that excludes it."""
    rows = web(spark, d).withColumn("rule", N.exclusion_rule("subset", BLOCKED, PATTERNS))
    return rows.groupBy("subset", "rule").agg(F.count(F.lit(1)).alias("documents"))


def length_bands(spark: SparkSession, d: str) -> DataFrame:
    """PF6, PF7: documents by stratum and band of words."""
    w = word_count("text")
    return read(spark, d, "documents").groupBy(B.length_stratum(w).alias("stratum"), B.length_band(w).alias("band")).agg(F.count(F.lit(1)).alias("documents"))


def minimum_length(spark: SparkSession, d: str) -> DataFrame:
    """PF5: documents of 50 and of 500 characters or more."""
    docs = read(spark, d, "documents").select("text")
    one = N.long_enough(docs, 50).agg(F.count(F.lit(1)).alias("ge_50"))
    return one.crossJoin(F.broadcast(N.long_enough(docs, 500).agg(F.count(F.lit(1)).alias("ge_500"))))  # one row each


def titled_texts(spark: SparkSession, d: str) -> DataFrame:
    """SC8: characters of texts with their titles put before them."""
    return read(spark, d, "documents").select("doc_id", F.length(N.titled("title", "text")).cast("long").alias("characters"))


def url_forms(spark: SparkSession, d: str) -> DataFrame:
    """Hosts and comparable URLs."""
    return read(spark, d, "documents").select("doc_id", url_host("original_url").alias("host"), canonical_url("original_url").alias("url"))


def line_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Lines, and the share of repeated ones, of every document."""
    return read(spark, d, "documents").select("doc_id", F.coalesce(F.size(lines("text")), F.lit(0)).cast("long").alias("lines"), F.round(repeated_line_ratio("text"), 9).alias("ratio"))


def corpus_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile by source and subset."""
    return P.corpus_profile(web(spark, d), ["source", "subset"])


def length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Nearest-rank percentiles of words by source."""
    return P.length_percentiles(P.measured(web(spark, d).select("source", "text")), ["source"])


def threshold_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents of many words by source."""
    return P.threshold_counts(web(spark, d).withColumn("words", word_count("text")), ["source"])


def word_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of all words."""
    return P.word_shares(web(spark, d).select("source", "subset", word_count("text").alias("words")))


def metadata_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Filled metadata by source."""
    return P.coverage(documents(spark, d, *[f for f in FIELDS if f not in ("subset", "content_sha256")]), FIELDS, ["source"])


def top_dates(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent dates."""
    return P.top_values(read(spark, d, "documents"), "publication_date", 10)


def word_outliers(spark: SparkSession, d: str) -> DataFrame:
    """Median, 0.9 point and longest document by source."""
    return P.outliers(web(spark, d).select("source", "doc_id", word_count("text").alias("words")), "source", "doc_id")


def repeated_contents(spark: SparkSession, d: str) -> DataFrame:
    """The twenty contents that occur most often."""
    return P.repeated_contents(records(spark, d), 20)


def formula_categories(spark: SparkSession, d: str) -> DataFrame:
    """PF14: kinds of parliamentary texts."""
    rows = web(spark, d).where(F.col("source") == "parlamentopt")
    return rows.groupBy(P.formula_category("text").alias("category")).agg(F.count(F.lit(1)).alias("documents"))


def outlier_classes(spark: SparkSession, d: str) -> DataFrame:
    """PF15: why texts are long, by source."""
    return web(spark, d).groupBy("source", P.outlier_class("text").alias("outlier")).agg(F.count(F.lit(1)).alias("documents"))


def _resolution(spark: SparkSession, d: str) -> DataFrame:
    return D.resolve(records(spark, d), RULE)


def exact_dedup_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Who owns each record's content."""
    return _resolution(spark, d).select("record_id", "content_sha256", "source", "subset", "words", "cluster_size", "owner_id", "disposition", "ownership_rule")


def exact_dedup_accounting(spark: SparkSession, d: str) -> DataFrame:
    """A1: documents and words before and after."""
    return D.accounting(_resolution(spark, d))


def exact_dedup_summary(spark: SparkSession, d: str) -> DataFrame:
    """A2: duplicate groups."""
    return D.group_summary(_resolution(spark, d))


def duplicate_edges(spark: SparkSession, d: str) -> DataFrame:
    """Dropped records and their owners."""
    return D.duplicate_edges(_resolution(spark, d))


def cluster_index(spark: SparkSession, d: str) -> DataFrame:
    """A3: clusters with their sources."""
    return D.cluster_index(_resolution(spark, d))


def source_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Contents shared within and across sources."""
    return D.source_pairs(records(spark, d))


def preserved_repeats(spark: SparkSession, d: str) -> DataFrame:
    """A4: what the preserved source repeats."""
    return D.repeats_in_preserved(records(spark, d), RULE)


def identity_audit(spark: SparkSession, d: str) -> DataFrame:
    """A5: identities claimed by several records."""
    return D.identity_audit(records(spark, d, "raw_source_file", "raw_record_identifier"), ("raw_source_file", "raw_record_identifier"))


def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Dispositions of the documents at hand."""
    return documents(spark, d).select("record_id").join(_resolution(spark, d).select("record_id", "disposition"), "record_id")


QUERIES = {
    f.__name__: f
    for f in (
        normalized_texts, contract_errors, normalize_rejects, subset_exclusion, length_bands, minimum_length, titled_texts, url_forms, line_ratios, corpus_profile, length_percentiles,
        threshold_counts, word_shares, metadata_coverage, top_dates, word_outliers, repeated_contents, formula_categories, outlier_classes, exact_dedup_resolution, exact_dedup_accounting,
        exact_dedup_summary, duplicate_edges, cluster_index, source_pairs, preserved_repeats, identity_audit, point_lookup,
    )
}

_INTERJECTIONS = "['apoiado', 'muito bem', 'palmas', 'risas', 'pausa', 'interrupção', 'protesto', 'vozes', 'nao apoiado', 'não apoiado', 'não!', 'sim!']"
_NORM = f"trim(nfc_normalize(regexp_replace(text, '\\r\\n?', chr(10), 'g')), {TRIM_SQL})"
_STRATUM = "CASE WHEN w < 20 THEN 'short' WHEN w < 1000 THEN 'medium' WHEN w < 100000 THEN 'long' ELSE 'giant' END"
_BAND = "CASE WHEN w < 20 THEN 'lt20' WHEN w < 100 THEN '20_99' WHEN w < 1000 THEN '100_999' WHEN w < 100000 THEN '1000_99999' ELSE 'ge100000' END"
_LINES = f"list_filter(list_transform(string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: trim(x, {TRIM_SQL})), lambda x: x <> '')"
_LETTERS = r"coalesce(length(regexp_replace(text, '[^\p{L}]+', '', 'g')), 0)"
_HOST = r"""nullif(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(
    regexp_extract(trim(original_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '^www\.', ''), '\.$', ''), '')"""
_PATH = r"""regexp_replace(regexp_replace(regexp_extract(trim(original_url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g'), '/$', '')"""
_COVERAGE = " UNION ALL ".join(
    f"SELECT source, count(*) AS documents, '{c}' AS field, count(*) FILTER (WHERE {filled_sql(c + "::VARCHAR")}) AS filled, round((count(*) - count(*) FILTER (WHERE {filled_sql(c + "::VARCHAR")})) / count(*), 6) AS missing_rate FROM nd GROUP BY source"
    for c in FIELDS
)

SQL = {
    "normalized_texts": f"""WITH n AS (SELECT doc_id, {_NORM} AS t FROM documents)
        SELECT doc_id, CASE WHEN t <> '' THEN sha256(t) END AS content_sha256, {words_sql("t")} AS words, coalesce(length(t), 0) AS characters FROM n""",
    "contract_errors": f"""WITH n AS (SELECT *, {_NORM} AS t FROM normalized_document), e AS (
        SELECT CASE WHEN text IS NULL OR text = '' THEN 'text_missing' END AS error FROM n
        UNION ALL SELECT CASE WHEN text <> t THEN 'text_not_normalized' END FROM n
        UNION ALL SELECT CASE WHEN NOT {filled_sql("source")} THEN 'source_missing' END FROM n
        UNION ALL SELECT CASE WHEN content_sha256 IS NULL OR NOT regexp_full_match(content_sha256, '[0-9a-f]{{64}}') THEN 'hash_malformed' END FROM n
        UNION ALL SELECT CASE WHEN content_sha256 <> CASE WHEN t <> '' THEN sha256(t) END THEN 'hash_wrong' END FROM n
        UNION ALL SELECT CASE WHEN language_score NOT BETWEEN 0 AND 1 THEN 'score_out_of_range' END FROM n)
        SELECT error, count(*) AS rows FROM e WHERE error IS NOT NULL GROUP BY error""",
    "normalize_rejects": f"""WITH n AS (SELECT concat_ws(',', CASE WHEN coalesce({_NORM}, '') = '' THEN 'blank_text' END, CASE WHEN NOT {filled_sql("source")} THEN 'no_source' END) AS r FROM normalized_document)
        SELECT CASE WHEN r = '' THEN 'accepted' ELSE r END AS outcome, count(*) AS rows FROM n GROUP BY 1""",
    "subset_exclusion": f"""WITH {WEB} SELECT subset, CASE WHEN subset IN ('culturax', 'hplt1') THEN 'blocked' WHEN subset ILIKE '%crawl%' OR subset ILIKE 'mc4%' THEN 'web_crawl'
        WHEN subset ILIKE 'blog_et' THEN 'blog' WHEN regexp_full_match(subset, '[op].*r.*') THEN 'common' END AS rule, count(*) AS documents FROM web GROUP BY 1, 2""",
    "length_bands": f"WITH n AS (SELECT {words_sql('text')} AS w FROM documents) SELECT {_STRATUM} AS stratum, {_BAND} AS band, count(*) AS documents FROM n GROUP BY 1, 2",
    "minimum_length": "SELECT count(*) FILTER (WHERE length(trim(text)) >= 50) AS ge_50, count(*) FILTER (WHERE length(trim(text)) >= 500) AS ge_500 FROM documents",
    "titled_texts": f"""SELECT doc_id, length(CASE WHEN {filled_sql("title")} AND NOT coalesce(starts_with(text, title), false) THEN concat_ws(chr(10) || chr(10), title, text) ELSE text END) AS characters FROM documents""",
    "url_forms": f"SELECT doc_id, {_HOST} AS host, {_HOST} || {_PATH} AS url FROM documents",
    "line_ratios": f"""WITH n AS (SELECT doc_id, {_LINES} AS l FROM documents)
        SELECT doc_id, coalesce(len(l), 0) AS lines, CASE WHEN len(l) > 0 THEN round((len(l) - len(list_distinct(l))) / len(l), 9) ELSE 0.0 END AS ratio FROM n""",
    "corpus_profile": f"""WITH {WEB}, n AS (SELECT source, subset, CASE WHEN {_NORM} <> '' THEN sha256({_NORM}) END AS h, coalesce(length(text), 0) AS c, {words_sql("text")} AS w, {_LETTERS} AS a, {_LINES} AS l FROM web)
        SELECT source, subset, count(*) AS documents, sum(c)::BIGINT AS characters, sum(w)::BIGINT AS words, round(coalesce(sum(a) / nullif(sum(c), 0), 0), 6) AS letter_ratio,
        count(*) FILTER (WHERE c < 100 OR w < 20) AS near_empty, count(*) FILTER (WHERE len(l) > 0 AND (len(l) - len(list_distinct(l))) / len(l) >= 0.2) AS repeating,
        count(DISTINCT h) AS contents, count(h) - count(DISTINCT h) AS surplus_copies FROM n GROUP BY source, subset""",
    "length_percentiles": f"""WITH {WEB}, n AS (SELECT source, {words_sql("text")} AS w FROM web)
        SELECT source, count(*) AS documents, min(w) AS least, quantile_disc(w, 0.5) AS p50, quantile_disc(w, 0.9) AS p90, quantile_disc(w, 0.95) AS p95, quantile_disc(w, 0.99) AS p99, max(w) AS greatest
        FROM n GROUP BY source""",
    "threshold_counts": f"WITH {WEB}, n AS (SELECT source, {words_sql('text')} AS w FROM web) SELECT source, " + ", ".join(f"count(*) FILTER (WHERE w >= {t}) AS ge_{t}" for t in P.THRESHOLDS) + " FROM n GROUP BY source",
    "word_shares": f"""WITH {WEB}, n AS (SELECT source, subset, {words_sql("text")} AS w FROM web)
        SELECT source, NULL AS subset, 'source' AS scope, sum(w)::BIGINT AS words, round(sum(w) / (SELECT sum(w) FROM n), 12) AS share FROM n GROUP BY source
        UNION ALL SELECT source, subset, 'subset', sum(w)::BIGINT, round(sum(w) / (SELECT sum(w) FROM n), 12) FROM n GROUP BY source, subset""",
    "metadata_coverage": f"WITH {ND} {_COVERAGE}",
    "top_dates": "SELECT publication_date, count(*) AS documents FROM documents WHERE publication_date IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "word_outliers": f"""WITH {WEB}, n AS (SELECT source, doc_id, {words_sql("text")} AS w FROM web),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY w) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM n)
        SELECT source, max(n) AS documents, max(w) FILTER (WHERE i = n // 2) AS median_words, max(w) FILTER (WHERE i = n * 9 // 10) AS p90_words, max(w) AS most_words,
        min(doc_id) FILTER (WHERE w = m) AS longest FROM (SELECT *, max(w) OVER (PARTITION BY source) AS m FROM r) GROUP BY source""",
    "repeated_contents": f"WITH {REC} SELECT content_sha256, count(*) AS records, max(words) AS words FROM rec WHERE content_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "formula_categories": f"""WITH {WEB}, n AS (SELECT lower(trim(coalesce(text, ''), {TRIM_SQL})) AS t FROM web WHERE source = 'parlamentopt'), w AS (SELECT t, {words_sql("t")} AS w,
            list_bool_or(list_transform({_INTERJECTIONS}, lambda p: contains(t, p))) AS holds, list_bool_or(list_transform({_INTERJECTIONS}, lambda p: t = p OR starts_with(t, p || ' '))) AS opens,
            list_bool_or(list_transform(['o sr.', 'o sr ', 'a sr.', 'a sr ', 'o senhor', 'a senhora', 'sr. presidente', 'sra. presidente', 'presidente:', 'o presidente:'], lambda p: starts_with(t, p))) AS speaker FROM n)
        SELECT CASE WHEN w <= 5 AND holds THEN 'procedural_utterance' WHEN speaker THEN 'speaker_label' WHEN w <= 5 THEN 'short_formula' WHEN opens THEN 'procedural_utterance'
            WHEN w > 200 THEN 'unexpectedly_long_repetition' ELSE 'parliamentary_formula' END AS category, count(*) AS documents FROM w GROUP BY 1""",
    "outlier_classes": rf"""WITH {WEB}, n AS (SELECT source, text, {words_sql("text")} AS w FROM web)
        SELECT source, CASE WHEN text IS NULL THEN NULL
            WHEN regexp_matches(left(text, 5000), '(?i)\bobras completas\b|\bobras escolhidas\b|\bcoletânea\b|\bantologia\b|\bvolume\s+[ivxlcdm0-9]+\b|\btomo\s+[ivxlcdm0-9]+\b|\b(primeira|segunda|terceira)\s+parte\b|\bpart\s+(i|ii|iii|iv|v|vi|vii|viii)\b') THEN 'collected_works_or_anthology'
            WHEN length(text) > 10000 AND contains(substr(text, (length(text) // 4) * 2 + 1), left(text, 500)) THEN 'duplicated_concatenation'
            WHEN w > 100000 THEN 'legitimate_very_large_text' ELSE 'unknown_outlier' END AS outlier, count(*) AS documents FROM n GROUP BY 1, 2""",
    "exact_dedup_resolution": f"WITH {RESOLVED} SELECT * FROM resolved",
    "exact_dedup_accounting": f"""WITH {RESOLVED}, a AS (
        SELECT source, subset, CASE WHEN grouping(subset) = 1 THEN 'source_total' ELSE 'source_subset' END AS scope, count(*) AS documents_before,
        count(*) FILTER (WHERE disposition = 'retained') AS documents_after, sum(words)::BIGINT AS words_before, sum(CASE WHEN disposition = 'retained' THEN words ELSE 0 END)::BIGINT AS words_after
        FROM resolved GROUP BY GROUPING SETS ((source), (source, subset)))
        SELECT *, round(CASE WHEN documents_before > 0 THEN (documents_before - documents_after) / documents_before ELSE 0 END, 12) AS document_loss,
        round(CASE WHEN words_before > 0 THEN (words_before - words_after) / words_before ELSE 0 END, 12) AS word_loss FROM a""",
    "exact_dedup_summary": f"""WITH {RESOLVED}, g AS (SELECT content_sha256, count(*) AS n, count(*) FILTER (WHERE disposition = 'dropped') AS d, count(DISTINCT source) AS s FROM resolved WHERE content_sha256 IS NOT NULL GROUP BY 1)
        SELECT count(*) FILTER (WHERE n > 1) AS duplicate_groups, sum(d)::BIGINT AS dropped, count(*) FILTER (WHERE s > 1) AS cross_source_groups FROM g""",
    "duplicate_edges": f"WITH {RESOLVED} SELECT record_id AS dropped_id, owner_id, content_sha256 FROM resolved WHERE disposition = 'dropped'",
    "cluster_index": f"""WITH {RESOLVED}, p AS (SELECT content_sha256, source, count(*) AS n FROM resolved WHERE content_sha256 IS NOT NULL GROUP BY ALL),
        u AS (SELECT content_sha256, string_agg(k || '=' || n, ',' ORDER BY k || '=' || n) AS subset_counts FROM
            (SELECT content_sha256, concat_ws('/', source, subset) AS k, count(*) AS n FROM resolved WHERE content_sha256 IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
        c AS (SELECT content_sha256, sum(n)::BIGINT AS records, (sum(n) - 1)::BIGINT AS duplicates, count(*) AS sources, string_agg(source || '=' || n, ',' ORDER BY source || '=' || n) AS source_counts FROM p GROUP BY 1)
        SELECT * FROM c JOIN u USING (content_sha256)""",
    "source_pairs": f"""WITH {REC}, p AS (SELECT content_sha256, source, count(*) AS n FROM rec WHERE content_sha256 IS NOT NULL AND source IS NOT NULL GROUP BY ALL)
        SELECT source AS source_a, source AS source_b, 'within_source' AS relation, count(*) AS contents, sum(n)::BIGINT AS records FROM p WHERE n > 1 GROUP BY source
        UNION ALL SELECT a.source, b.source, 'cross_source', count(*), sum(a.n + b.n)::BIGINT FROM p a JOIN p b USING (content_sha256) WHERE a.source < b.source GROUP BY ALL""",
    "preserved_repeats": f"WITH {REC} SELECT content_sha256, count(*) AS records, count(*) - 1 AS surplus FROM rec WHERE source = 'parlamentopt' AND content_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "identity_audit": f"""WITH {REC}, c AS (SELECT count(DISTINCT record_id) AS n, count(DISTINCT content_sha256) AS k FROM rec
        WHERE raw_source_file IS NOT NULL AND raw_record_identifier IS NOT NULL GROUP BY raw_source_file, raw_record_identifier)
        SELECT (SELECT count(*) FROM rec) AS rows, (SELECT count(DISTINCT record_id) FROM rec) AS distinct_records, count(*) FILTER (WHERE n > 1) AS repeated_identities,
        count(*) FILTER (WHERE n > 1 AND k > 1) AS conflicting_identities FROM c""",
    "point_lookup": f"WITH {RESOLVED}, {ND} SELECT nd.record_id, disposition FROM nd JOIN resolved USING (record_id)",
}
