"""Packing of token sequences and fragmentation of words over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITE_SPACE
from ..operators import fragmentation as T
from ..operators import packing as K
from .base import WORD_SQL, read, web

POLICY = K.PackingPolicy(context=1024)
FILE = "/opt/tokenizers/piece_bpe_32k.model"
CANDIDATES = {"piece_bpe_32k": FILE, "byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.json"}


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    """Documents as token ids: words by hash, a split by the last digit of the id."""
    words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), WHITE_SPACE, " " * len(WHITE_SPACE)), " +"), lambda w: w != "")
    split = F.when(F.col("doc_id") % 10 == 0, "validation").otherwise("train")
    ids = F.transform("w", lambda w: (F.conv(F.substring(F.sha2(w, 256), 1, 7), 16, 10).cast("long") % (POLICY.vocabulary - 3) + 3).cast("int"))
    rows = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), split.alias("split"), words.alias("w"))
    return rows.select("document_id", "split", ids.alias("token_ids"))


def _offsets(spark: SparkSession, d: str) -> DataFrame:
    return K.stream_offsets(_tokens(spark, d).select("document_id", "split", F.size("token_ids").alias("n_tokens")), POLICY)


def stream_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Places of documents in their split's stream."""
    return _offsets(spark, d).select("document_id", "split", "n_tokens", "stream_start", "stream_end")


def packed_windows(spark: SparkSession, d: str) -> DataFrame:
    """K2, K3: windows, told apart by their sums and ends."""
    w = K.windows(_tokens(spark, d), POLICY)
    total = F.aggregate("input_ids", F.lit(0).cast("long"), lambda s, x: s + x)
    return w.select("split", "window", "owned_targets", "padding", total.alias("total"), F.element_at("input_ids", 1).cast("long").alias("first"), F.element_at("labels", 1).cast("long").alias("first_label"))


def window_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each window."""
    return K.window_provenance(_offsets(spark, d), POLICY)


def packing_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Payload, targets and padding of each split."""
    return K.accounting(_offsets(spark, d), POLICY)


def packing_check(spark: SparkSession, d: str) -> DataFrame:
    """K5, K6: what the check finds in windows damaged on purpose: a token outside the vocabulary in each first window, padding in each second one, documents whose id hashes to 0... given twice."""
    t = _tokens(spark, d)
    w = K.windows(t, POLICY)
    ids = F.when(F.col("window") == 0, F.concat(F.array(F.lit(POLICY.vocabulary)), F.slice("input_ids", 2, POLICY.context - 1))).otherwise(F.col("input_ids"))
    w = w.withColumns({"input_ids": ids, "padding": F.when(F.col("window") == 1, F.lit(1).cast("long")).otherwise(F.col("padding"))})
    return K.violations(t.unionByName(t.where(F.sha2("document_id", 256).startswith("0"))), w, POLICY)


def fragmentation(spark: SparkSession, d: str) -> DataFrame:
    """Pieces per word by source."""
    return T.fragmentation(web(spark, d).withColumn("source", F.coalesce("source", F.lit(""))), FILE, ["source"])


def tokenizer_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Vocabularies side by side, by source."""
    return T.compare(web(spark, d).withColumn("source", F.coalesce("source", F.lit(""))), CANDIDATES, ["source"])


def macro_fragmentation(spark: SparkSession, d: str) -> DataFrame:
    """Mean over sources."""
    return T.macro_average(T.fragmentation(web(spark, d), FILE, ["source", "subset"]), "tokens_per_word")


QUERIES = {f.__name__: f for f in (stream_offsets, packed_windows, window_provenance, packing_accounting, packing_check, fragmentation, tokenizer_comparison, macro_fragmentation)}

_C = POLICY.context
_OFFSETS = f"""tok AS (SELECT doc_id::VARCHAR AS document_id, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split,
    list_transform(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}'), lambda w: ('0x' || substr(sha256(w), 1, 7))::BIGINT % {POLICY.vocabulary - 3} + 3) AS ids FROM documents),
o AS (SELECT *, len(ids) AS n_tokens, (sum(len(ids) + 1) OVER (PARTITION BY split ORDER BY
        sha256('packing-order-v1' || chr(0) || CASE WHEN split = 'train' THEN '0' ELSE 'fixed-heldout' END || chr(0) || document_id), document_id))::BIGINT AS stream_end FROM tok),
off AS (SELECT *, stream_end - n_tokens - 1 AS stream_start FROM o)"""
_STREAM = f"""{_OFFSETS}, s AS (SELECT split, stream_start + i - 1 AS p, CASE WHEN i <= n_tokens THEN ids[i] ELSE {POLICY.end} END AS t FROM (SELECT *, unnest(range(1, n_tokens + 2)) AS i FROM off)),
len AS (SELECT split, max(p) + 1 AS n FROM s GROUP BY split)"""
SQL = {
    "stream_offsets": f"WITH {_OFFSETS} SELECT document_id, split, n_tokens, stream_start, stream_end FROM off",
    "packed_windows": f"""WITH {_STREAM}, w AS (SELECT split, p // {_C} AS w, count(*) AS n, sum(t) AS total, arg_min(t, p) AS first FROM s JOIN len USING (split) WHERE p < len.n - 1 GROUP BY 1, 2)
        SELECT w.split, w.w AS window, w.n AS owned_targets, {_C} - w.n AS padding, (w.total + ({_C} - w.n) * {POLICY.end})::BIGINT AS total, w.first, s.t AS first_label
        FROM w JOIN s ON s.split = w.split AND s.p = w.w * {_C} + 1""",
    "window_provenance": f"""WITH {_OFFSETS}, x AS (SELECT split, document_id, stream_start, stream_end, unnest(range(greatest(stream_start - 1, 0) // {_C}, greatest(stream_end - 2, 0) // {_C} + 1)) AS w FROM off WHERE stream_end > 1)
        SELECT split, w AS window, document_id, greatest(stream_start, w * {_C} + 1) AS from_position, least(stream_end, (w + 1) * {_C} + 1) AS to_position FROM x
        WHERE greatest(stream_start, w * {_C} + 1) < least(stream_end, (w + 1) * {_C} + 1)""",
    "packing_accounting": f"""WITH {_OFFSETS}, a AS (SELECT split, count(*) AS documents, sum(n_tokens)::BIGINT AS payload, max(stream_end) AS stream FROM off GROUP BY split)
        SELECT *, documents AS end_tokens, stream - 1 AS targets, (stream - 1 + {_C - 1}) // {_C} AS windows, (stream - 1 + {_C - 1}) // {_C} * {_C} - stream + 1 AS padding FROM a""",
    "packing_check": f"""WITH {_OFFSETS}, l AS (SELECT split, (max(stream_end) - 2) // {_C} AS last FROM off GROUP BY split),
        n AS (SELECT 'repeated_document' AS check, (SELECT count(*) FROM tok WHERE starts_with(sha256(document_id), '0')) AS n UNION ALL SELECT 'malformed_window', (SELECT count(*) FROM l)
            UNION ALL SELECT 'unfilled_inner_window', (SELECT count(*) FROM l WHERE last > 1))
        SELECT * FROM n WHERE n > 0""",
}
