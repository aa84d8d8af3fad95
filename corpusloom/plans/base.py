"""What the queries share: current rows in comparable form, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hex_key, label_key
from ..functions.text import WHITE_SPACE, word_count
from ..operators.current import latest_rows
from ..operators.exact_dedup import Ownership

#: The project's sources in comparable form, and the tiers of the collection that is ranked by subset.
RULE = Ownership(
    primary=("carolina", "gutenbergpt", "wikipediapt"),
    preserved=("parlamentopt",),
    tiers={
        "finepdfsporlatn": 1, "crawlptdedup": 2, "quati": 2, "blogset": 2, "fineweb2pt": 3,
        "mc4pt": 4, "hplt2pt": 4, "hplt1pt": 4, "commoncrawl": 4, "oscar": 4, "culturax": 4,
    },
)
SEED = 20261013

WORD_SQL = r"[^\s\p{Z}\x0b\x1c-\x1f\x{85}]+"
TRIM_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *more: str | Column) -> DataFrame:
    """Current rows of normalized_document: ``record_id, source, subset, content_sha256, words, loaded_at`` and more columns."""
    rows = read(spark, sf_dir, "normalized_document").select(
        hex_key("record_id").alias("record_id"), label_key("source").alias("source"), label_key("subset").alias("subset"),
        F.nullif(hex_key("content_sha256"), F.lit("")).alias("content_sha256"), word_count("text").alias("words"), "loaded_at", *more,
    )
    return latest_rows(rows, ["record_id"], "loaded_at", ["content_sha256"])


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with source and subset in comparable form."""
    return read(spark, sf_dir, "documents").withColumns({"source": label_key("source"), "subset": label_key("subset")})


def records(spark: SparkSession, sf_dir: str, *more: str | Column) -> DataFrame:
    """Current rows of records: ``record_id, source, subset, content_sha256, words, loaded_at`` and more columns."""
    rows = read(spark, sf_dir, "records").select(
        hex_key("record_id").alias("record_id"), label_key("source").alias("source"), label_key("subset").alias("subset"),
        F.nullif(hex_key("content_sha256"), F.lit("")).alias("content_sha256"), F.col("normalized_words").alias("words"), "loaded_at", *more,
    )
    return latest_rows(rows, ["record_id"], "loaded_at", ["content_sha256"])


def key_sql(column: str) -> str:
    return f"lower(regexp_replace(nfc_normalize({column}), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


def hex_sql(column: str) -> str:
    return f"lower(regexp_replace({column}, '[^0-9A-Za-z]+', '', 'g'))"


def words_sql(column: str) -> str:
    return f"coalesce(len(regexp_extract_all({column}, '{WORD_SQL}')), 0)"


def filled_sql(column: str) -> str:
    return f"(coalesce(lower(trim({column}, {TRIM_SQL})), '') NOT IN ('', 'none'))"


def _current(table: str, words: str) -> str:
    return f"""
    SELECT {hex_sql("record_id")} AS record_id, {key_sql("source")} AS source, {key_sql("subset")} AS subset,
           nullif({hex_sql("content_sha256")}, '') AS content_sha256, {words} AS words,
           * EXCLUDE (record_id, source, subset, content_sha256)
    FROM {table}
    QUALIFY row_number() OVER (PARTITION BY {hex_sql(f"{table}.record_id")} ORDER BY loaded_at DESC NULLS LAST, {hex_sql(f"{table}.content_sha256")} DESC NULLS LAST) = 1"""


ND = f"nd AS ({_current('normalized_document', words_sql('text'))})"
REC = f"rec AS ({_current('records', 'normalized_words')})"
WEB = f"web AS (SELECT * REPLACE ({key_sql('source')} AS source, {key_sql('subset')} AS subset) FROM documents)"

SUBSET_TIER = """CASE subset WHEN 'finepdfsporlatn' THEN 1 WHEN 'crawlptdedup' THEN 2 WHEN 'quati' THEN 2 WHEN 'blogset' THEN 2 WHEN 'fineweb2pt' THEN 3
    WHEN 'mc4pt' THEN 4 WHEN 'hplt2pt' THEN 4 WHEN 'hplt1pt' THEN 4 WHEN 'commoncrawl' THEN 4 WHEN 'oscar' THEN 4 WHEN 'culturax' THEN 4 ELSE 5 END"""
_TIER = f"CASE WHEN source IN ('carolina', 'gutenbergpt', 'wikipediapt') THEN 0 ELSE {SUBSET_TIER} END"
RESOLVED = f"""{REC},
claim AS (
    SELECT *, source = 'parlamentopt' AS preserved, CASE WHEN source IN ('carolina', 'gutenbergpt', 'wikipediapt') THEN 0 ELSE 1 END AS kind, {_TIER} AS tier FROM rec),
owner AS (
    SELECT content_sha256, record_id AS winner, kind AS winner_kind, count(*) OVER (PARTITION BY content_sha256) AS size
    FROM claim WHERE NOT preserved AND content_sha256 IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY content_sha256 ORDER BY kind, tier, source, subset, record_id) = 1),
resolved AS (
    SELECT record_id, content_sha256, source, subset, words,
           CASE WHEN preserved OR content_sha256 IS NULL THEN 0 ELSE size END AS cluster_size,
           CASE WHEN preserved OR content_sha256 IS NULL THEN record_id ELSE winner END AS owner_id,
           CASE WHEN preserved OR content_sha256 IS NULL OR winner = record_id THEN 'retained' ELSE 'dropped' END AS disposition,
           CASE WHEN content_sha256 IS NULL THEN 'no_content' WHEN preserved THEN 'preserved' WHEN size = 1 THEN 'singleton'
                WHEN winner_kind = 0 THEN 'primary_first' ELSE 'tier_order' END AS ownership_rule
    FROM claim LEFT JOIN owner USING (content_sha256))"""
