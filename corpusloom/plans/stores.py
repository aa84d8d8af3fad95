"""Files, sinks, streams and SQL functions over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.register import register
from ..functions.text import content_hash
from ..runtime import Workspace
from ..sources import readers as R
from ..sources import writers as W
from ..streaming import streams as T
from .base import TRIM_SQL, WEB, read, web, words_sql


def footer_rows(spark: SparkSession, d: str) -> DataFrame:
    """SC3, SC15: row groups' rows from the footers of all tables of this project, without reading their data."""
    files = [f for f in R.discover(spark, d) if f.rsplit("/", 1)[-1] in ("candidate.parquet", "documents.parquet", "pairs.parquet", "records.parquet", "refs.parquet")]
    groups = R.row_groups(spark, files)
    return groups.groupBy(F.regexp_extract("file", r"([^/]+)\.parquet$", 1).alias("table")).agg(F.sum("rows").alias("rows"))


def constant_columns(spark: SparkSession, d: str) -> DataFrame:
    """SC4: columns that hold one value and no NULL, told from footers alone."""
    files = [f for f in R.discover(spark, d) if f.rsplit("/", 1)[-1] in ("benchmark_field.parquet", "normalized_document.parquet", "mix_plan.parquet")]
    return R.constant_columns(spark, files).select(F.regexp_extract("file", r"([^/]+)\.parquet$", 1).alias("table"), "column", "value")


def stored_by_subset(spark: SparkSession, d: str) -> DataFrame:
    """SK2, SC5: documents written by subset with provenance, and what the partitioned reader finds again."""
    path = Workspace(spark).path("by-subset")
    W.write_by_subset(web(spark, d).select("subset", "text").where(F.col("subset").isNotNull()), path, {"origin": "here"})
    again = spark.read.parquet(path)
    return again.groupBy("subset", "origin").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("characters"))


def stream_first_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Streams: contents of normalized documents as a stream delivers them, each once."""
    schema = read(spark, d, "normalized_document").schema
    # A stream takes a single file only by a pattern, which finds a folder of parts too. Its first batch drops rows
    # at or before 1970-01-01 00:00:00 as late, so those without a time and older ones stand a second behind it.
    table = spark.readStream.schema(schema).option("basePath", d).parquet(f"{d}/normalized_document.parque[t]")
    stream = table.select("text", F.greatest("loaded_at", F.timestamp_seconds(F.lit(1))).alias("at"))
    ws = Workspace(spark)
    path = ws.path("fresh")
    T.write_batches(T.first_deliveries(stream, "at", "36500 days"), path, ws.path("progress")).awaitTermination()
    return spark.read.parquet(path).select("content_sha256")


def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """2.13: registered functions in SQL text."""
    register(spark)
    read(spark, d, "documents").createOrReplaceTempView("cl_documents")
    return spark.sql("SELECT doc_id, cl_word_count(text) AS words, cl_letter_count(text) AS letters, size(cl_match_tokens(text)) AS tokens, length(cl_nfc(text)) AS characters, cl_fold_key(source) AS source FROM cl_documents")


def normalized_table(spark: SparkSession, d: str) -> DataFrame:
    """PF2, SK1: documents as normalized rows, written whole and checked against the fixed schema when read again; filled columns by source."""
    from ..operators.normalize import normalize_records
    from ..schema import NORMALIZED_SCHEMA

    raw = web(spark, d).select("text", "source", "subset", "original_id", "original_url", F.col("lang").alias("language"), "publication_date", "domain_category", "title",
                               F.lit("documents").alias("raw_source_file"), F.col("doc_id").cast("string").alias("raw_record_identifier"))
    good, _ = normalize_records(raw)
    path = Workspace(spark).path("normalized")
    W.write_table(good, path)
    again = W.load_sample(spark, path, NORMALIZED_SCHEMA)
    return again.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("characters"), F.count("title").alias("titles"), F.count("subset").alias("subsets"), F.count_distinct("content_sha256").alias("contents"))


QUERIES = {f.__name__: f for f in (footer_rows, constant_columns, stored_by_subset, stream_first_deliveries, sql_functions, normalized_table)}

_NORM = f"trim(nfc_normalize(regexp_replace(text, '\\r\\n?', chr(10), 'g')), {TRIM_SQL})"


def _constant(table: str, *columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", min({c})::VARCHAR AS value FROM {table} HAVING min({c}) = max({c}) AND count({c}) = count(*)" for c in columns)


SQL = {
    "footer_rows": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("candidate", "documents", "pairs", "records", "refs")),
    "constant_columns": _constant("benchmark_field", "benchmark_name", "example_id", "source_row_id", "source_file_sha256", "source_category", "field_id", "field_role", "original_text", "matchable")
    + " UNION ALL " + _constant("mix_plan", "component", "share_bp", "max_repeats", "budget_tokens")
    + " UNION ALL " + _constant("normalized_document", "record_id", "text", "source", "source_revision", "subset", "original_id", "original_url", "license", "language", "variety", "publication_date",
        "domain_category", "content_sha256", "title", "raw_source_file", "raw_record_identifier", "normalization_version", "_gv2_upstream_shard", "_gv2_upstream_row_group", "_gv2_upstream_commit", "upstream_metadata_json"),
    "stored_by_subset": f"WITH {WEB} SELECT subset, 'here' AS origin, count(*) AS documents, sum(length(text))::BIGINT AS characters FROM web WHERE subset IS NOT NULL GROUP BY subset",
    "stream_first_deliveries": f"SELECT DISTINCT sha256({_NORM}) AS content_sha256 FROM normalized_document WHERE {_NORM} <> ''",
    "sql_functions": rf"""SELECT doc_id, {words_sql("text")} AS words, coalesce(length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')), 0) AS letters,
        coalesce(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}\p{{M}}]*')), 0)::INTEGER AS tokens, length(nfc_normalize(text))::INTEGER AS characters,
        lower(regexp_replace(nfc_normalize(source), '[^\p{{L}}\p{{N}}]+', '', 'g')) AS source FROM documents""",
    "normalized_table": f"""WITH {WEB}, n AS (SELECT *, {_NORM} AS t FROM web)
        SELECT source, count(*) AS rows, sum(length(t))::BIGINT AS characters, count(CASE WHEN coalesce(lower(trim(title, {TRIM_SQL})), '') NOT IN ('', 'none') THEN 1 END) AS titles,
            count(CASE WHEN coalesce(subset, '') NOT IN ('', 'none') THEN 1 END) AS subsets, count(DISTINCT sha256(t)) AS contents FROM n WHERE t <> '' AND coalesce(source, '') NOT IN ('', 'none') GROUP BY source""",
}
