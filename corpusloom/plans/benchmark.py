"""Overlap of documents with benchmark items over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import overlap as O
from ..operators.current import bottom_k
from ..runtime import Workspace
from .base import read

POLICY = O.OverlapPolicy()


def _fields(spark: SparkSession, d: str, matchable: bool = True) -> DataFrame:
    rows = read(spark, d, "benchmark_field")
    return O.tokenized(O.question_answers(rows).where("matchable") if matchable else rows, "original_text", "field_id", "example_id", "field_role")


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return O.tokenized(read(spark, d, "benchmark_field").where("field_role = 'correct_answer'"), "original_text", "example_id")


def _found(spark: SparkSession, d: str, fields: DataFrame | None = None) -> DataFrame:
    return O.scan(read(spark, d, "documents").select("doc_id", "text"), _fields(spark, d) if fields is None else fields, _answers(spark, d), POLICY)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return O.anchor_hits(_found(spark, d))


def field_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Fields and tokens by role, the role of question and answer in one text among them."""
    made = O.question_answers(read(spark, d, "benchmark_field"))
    rows = O.tokenized(made, "original_text", "field_role", "matchable")
    return rows.groupBy("field_role", "matchable").agg(F.count(F.lit(1)).alias("fields"), F.sum(F.size("tokens")).alias("tokens"), F.max(F.size("tokens")).cast("long").alias("longest"))


def anchor_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Anchors by the number of items they lie in."""
    rows = O.anchor_frequency(O.anchors(_fields(spark, d), POLICY))
    return rows.groupBy("items").agg(F.count(F.lit(1)).alias("anchors"))


def anchor_hits(spark: SparkSession, d: str) -> DataFrame:
    """Anchors found in each document, by field."""
    return _hits(spark, d).groupBy("doc_id", "field_id").agg(F.count(F.lit(1)).alias("hits"), F.min("doc_position").cast("long").alias("first_at"))


def anchor_documents(spark: SparkSession, d: str) -> DataFrame:
    """Hits whose anchor lies in few documents."""
    return O.without_frequent(_hits(spark, d), POLICY).groupBy("field_id").agg(F.count_distinct("doc_id").alias("documents"))


def exact_items(spark: SparkSession, d: str) -> DataFrame:
    """Whole fields in documents."""
    return O.exact_fields(O.exact_places(_found(spark, d))).select("doc_id", "field_id", "field_role", F.col("start").cast("long").alias("start"), F.col("size").cast("long").alias("size"))


def token_runs(spark: SparkSession, d: str) -> DataFrame:
    """Merged runs of anchors."""
    return O.runs(_hits(spark, d), POLICY).select("doc_id", "field_id", F.col("start").cast("long").alias("start"), F.col("field_start").cast("long").alias("field_start"), "size")


def distinctive_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The share of a field's distinctive places that the best coherent alignment covers."""
    marks = O.anchors(_fields(spark, d), POLICY)
    return O.coverage(O.without_frequent(_hits(spark, d), POLICY), _fields(spark, d), O.distinctive_positions(marks, POLICY), POLICY)


def _with_controls(spark: SparkSession, d: str) -> DataFrame:
    """All documents and a control for each item that has a question and an answer: both, 0 to 199 tokens apart. Controls have negative ids."""
    f = read(spark, d, "benchmark_field")
    q = f.where("field_role = 'question'").select("example_id", F.col("original_text").alias("q"))
    a = f.where("field_role = 'correct_answer'").select("example_id", F.col("original_text").alias("a"))
    number = F.conv(F.substring(F.sha2("example_id", 256), 1, 8), 16, 10).cast("long")
    docs = read(spark, d, "documents").select("doc_id", "text")
    controls = q.join(a, "example_id").select((-number).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.concat("q", F.lit(" "), F.repeat(F.lit("x "), (number % 200).cast("int")), F.col("a")).alias("text"))
    return docs.unionByName(controls)


def near_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers near their questions, in the documents and in controls."""
    questions = _fields(spark, d, matchable=False).where("field_role = 'question'")
    found = Workspace(spark).write(O.scan(_with_controls(spark, d), questions, _answers(spark, d), POLICY))  # read twice, searched for once
    return O.near_answers(O.exact_places(found), O.answer_places(found), POLICY).select("doc_id", "example_id", *[F.col(c).cast("long").alias(c) for c in ("question_start", "answer_start", "distance")])


def overlap_preflight(spark: SparkSession, d: str) -> DataFrame:
    """What a scan would read."""
    return O.preflight(read(spark, d, "documents"), read(spark, d, "benchmark_field"))


def control_panel(spark: SparkSession, d: str) -> DataFrame:
    """SM13: the eight items of smallest rank of each benchmark and role, to make controls of."""
    rows = read(spark, d, "benchmark_field").where("matchable").select("benchmark_name", "field_role", "field_id", F.sha2(F.concat(F.lit("panel-v1\0"), "field_id"), 256).alias("rank"))
    return bottom_k(rows, ["benchmark_name", "field_role"], "rank", "field_id", 8)


def overlap_hits(spark: SparkSession, d: str) -> DataFrame:
    """Every hit with its rule."""
    return O.hits_by_rule(read(spark, d, "documents"), read(spark, d, "benchmark_field"), POLICY)


def overlap_exact_rules(spark: SparkSession, d: str) -> DataFrame:
    """The hits of all rules but the alignment, which SQL cannot express."""
    return overlap_hits(spark, d).where("rule <> 'distinctive_anchor_coverage'").withColumn("start", F.col("start").cast("long"))


def overlap_summary(spark: SparkSession, d: str) -> DataFrame:
    """Documents and items by rule; nothing is excluded."""
    return overlap_hits(spark, d).groupBy("rule").agg(F.count_distinct("doc_id").alias("documents"), F.count_distinct("example_id").alias("items"), F.lit(0).cast("long").alias("excluded"))


def scan_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Rows and digests of keys by source."""
    return O.scan_accounting(read(spark, d, "documents").select("source", "doc_id"), "source", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        field_sizes, anchor_frequency, anchor_hits, anchor_documents, exact_items, token_runs, distinctive_coverage, near_answers, overlap_preflight, control_panel, overlap_hits, overlap_exact_rules, overlap_summary, scan_accounting,
    )
}


def _tokens(column: str) -> str:
    return rf"regexp_extract_all(replace(lower(nfc_normalize(coalesce({column}, ''))), 'ß', 'ss'), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}\p{{M}}]*')"


_RUN = POLICY.anchor
_BASE = f"""doc AS (SELECT doc_id, {_tokens("text")} AS t FROM documents),
made AS (SELECT q.example_id || ':question_plus_answer' AS field_id, example_id, 'question_plus_answer' AS field_role, true AS matchable, q.original_text || ' ' || a.original_text AS original_text
    FROM benchmark_field q JOIN benchmark_field a USING (example_id) WHERE q.field_role = 'question' AND a.field_role = 'correct_answer'),
field AS (SELECT field_id, example_id, field_role, matchable, {_tokens("original_text")} AS t FROM (SELECT field_id, example_id, field_role, matchable, original_text FROM benchmark_field UNION ALL FROM made)),
mark AS (SELECT field_id, example_id, i - 1 AS position, array_to_string(t[i:i + {_RUN - 1}], ' ') AS words FROM
    (SELECT *, unnest(range(1, len(t) - {_RUN} + 2)) AS i FROM field WHERE matchable AND field_role IN {POLICY.anchored_roles}))"""
_HITS = f"""{_BASE}, place AS (SELECT doc_id, i - 1 AS position, array_to_string(t[i:i + {_RUN - 1}], ' ') AS words FROM (SELECT *, unnest(range(1, len(t) - {_RUN} + 2)) AS i FROM doc)),
hit AS (SELECT doc_id, field_id, example_id, p.position AS doc_position, m.position AS field_position, words FROM place p JOIN mark m USING (words))"""
_EXACT = f"""{_BASE}, flat AS (SELECT doc_id, ' ' || array_to_string(t, ' ') || ' ' AS s FROM doc),
exact AS (SELECT doc_id, field_id, example_id, field_role, len(t) AS size, len(string_split(left(s, strpos(s, ' ' || array_to_string(t, ' ') || ' ')), ' ')) - 2 AS start
    FROM flat JOIN field ON contains(s, ' ' || array_to_string(t, ' ') || ' ') WHERE len(t) > 0 AND field_role <> 'target_word')"""

SQL = {
    "field_sizes": f"""WITH f AS (SELECT field_role, matchable, {_tokens("original_text")} AS t FROM benchmark_field
        UNION ALL SELECT 'question_plus_answer', true, {_tokens("q.original_text || ' ' || a.original_text")} FROM benchmark_field q JOIN benchmark_field a USING (example_id)
            WHERE q.field_role = 'question' AND a.field_role = 'correct_answer')
        SELECT field_role, matchable, count(*) AS fields, sum(len(t))::BIGINT AS tokens, max(len(t)) AS longest FROM f GROUP BY 1, 2""",
    "anchor_frequency": f"WITH {_BASE}, f AS (SELECT words, count(DISTINCT example_id) AS items FROM mark GROUP BY words) SELECT items, count(*) AS anchors FROM f GROUP BY items",
    "anchor_hits": f"WITH {_HITS} SELECT doc_id, field_id, count(*) AS hits, min(doc_position) AS first_at FROM hit GROUP BY 1, 2",
    "anchor_documents": f"""WITH {_HITS}, often AS (SELECT words FROM hit GROUP BY words HAVING count(DISTINCT doc_id) > {POLICY.document_frequency})
        SELECT field_id, count(DISTINCT doc_id) AS documents FROM hit WHERE words NOT IN (SELECT words FROM often) GROUP BY field_id""",
    "exact_items": f"WITH {_EXACT} SELECT doc_id, field_id, field_role, start, size FROM exact JOIN (SELECT field_id FROM field WHERE matchable) USING (field_id)",
    "token_runs": f"""WITH {_HITS}, g AS (SELECT DISTINCT doc_id, field_id, doc_position, field_position, doc_position - field_position AS o FROM hit),
        n AS (SELECT *, CASE WHEN field_position - lag(field_position) OVER (PARTITION BY doc_id, field_id, o ORDER BY field_position) > {_RUN} THEN 1 ELSE 0 END AS new FROM g),
        i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, field_id, o ORDER BY field_position) AS k FROM n)
        SELECT doc_id, field_id, min(doc_position) AS start, min(field_position) AS field_start, max(field_position) - min(field_position) + {_RUN} AS size FROM i GROUP BY doc_id, field_id, o, k""",
    "near_answers": f"""WITH {_BASE}, num AS (SELECT q.example_id, ('0x' || substr(sha256(q.example_id), 1, 8))::BIGINT AS n, q.original_text AS q, a.original_text AS a
            FROM benchmark_field q JOIN benchmark_field a USING (example_id) WHERE q.field_role = 'question' AND a.field_role = 'correct_answer'),
        every AS (SELECT doc_id, t FROM doc UNION ALL SELECT -n, {_tokens("q || ' ' || repeat('x ', n % 200) || a")} FROM num),
        q AS (SELECT doc_id, example_id, i - 1 AS s, len(f.t) AS n FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM every) d JOIN field f ON d.t[i] = f.t[1] AND d.t[i:i + len(f.t) - 1] = f.t WHERE field_role = 'question'),
        a AS (SELECT doc_id, example_id, i - 1 AS s, len(f.t) AS n FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM every WHERE doc_id IN (SELECT doc_id FROM q)) d
            JOIN field f ON d.t[i] = f.t[1] AND d.t[i:i + len(f.t) - 1] = f.t WHERE field_role = 'correct_answer'),
        n AS (SELECT doc_id, example_id, q.s AS question_start, a.s AS answer_start, greatest(0, q.s - a.s - a.n, a.s - q.s - q.n) AS distance FROM q JOIN a USING (doc_id, example_id))
        SELECT doc_id, example_id, question_start, min(answer_start) AS answer_start, arg_min(distance, answer_start) AS distance FROM n WHERE distance <= {POLICY.gap} GROUP BY 1, 2, 3""",
    "overlap_preflight": """SELECT 'documents' AS measure, count(*) AS n FROM documents UNION ALL SELECT 'documents_without_text', count(*) - count(text) FROM documents
        UNION ALL SELECT 'characters', sum(length(text))::BIGINT FROM documents UNION ALL SELECT 'repeated_ids', count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)
        UNION ALL SELECT 'fields', count(*) FROM benchmark_field UNION ALL SELECT 'matchable_fields', count(*) FILTER (WHERE matchable) FROM benchmark_field UNION ALL SELECT 'items', count(DISTINCT example_id) FROM benchmark_field
        UNION ALL SELECT 'fields_without_text', count(*) - count(original_text) FROM benchmark_field UNION ALL SELECT 'benchmark_characters', sum(length(original_text)) FILTER (WHERE matchable)::BIGINT FROM benchmark_field""",
    "overlap_exact_rules": f"""WITH {_HITS}, place_of AS (SELECT doc_id, field_id, example_id, field_role, i - 1 AS s, len(f.t) AS n
            FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM doc) d JOIN field f ON d.t[i] = f.t[1] AND d.t[i:i + len(f.t) - 1] = f.t
            WHERE matchable AND field_role IN ('complete_item', 'context', 'passage', 'question_plus_answer', 'question')),
        first_place AS (SELECT doc_id, field_id, example_id, field_role, min(s) AS start FROM place_of GROUP BY ALL),
        ans AS (SELECT doc_id, example_id, i - 1 AS s, len(f.t) AS n FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM doc WHERE doc_id IN (SELECT doc_id FROM place_of WHERE field_role = 'question')) d
            JOIN field f ON d.t[i] = f.t[1] AND d.t[i:i + len(f.t) - 1] = f.t WHERE field_role = 'correct_answer'),
        beside AS (SELECT q.doc_id, q.example_id, least(q.s, ans.s) AS start FROM place_of q JOIN ans USING (doc_id, example_id)
            WHERE q.field_role = 'question' AND q.n >= 6 AND greatest(0, q.s - ans.s - ans.n, ans.s - q.s - q.n) <= 128),
        whole AS (SELECT doc_id, example_id, field_id, 'exact_' || field_role AS rule, start FROM first_place WHERE field_role <> 'question'
            UNION ALL SELECT b.doc_id, b.example_id, f.field_id, 'exact_question_plus_answer', b.start FROM beside b JOIN field f ON f.example_id = b.example_id AND f.field_role = 'question_plus_answer'),
        rare AS (SELECT t FROM field WHERE matchable AND field_role = 'question' AND len(t) >= 6 GROUP BY t HAVING count(DISTINCT example_id) <= 2),
        posed AS (SELECT p.* FROM first_place p JOIN field f USING (field_id) WHERE p.field_role = 'question' AND f.t IN (SELECT t FROM rare)),
        asked AS (SELECT doc_id, example_id, field_id, 'exact_distinctive_question' AS rule, start FROM posed WHERE field_id NOT IN (SELECT field_id FROM posed GROUP BY field_id HAVING count(DISTINCT doc_id) > 100)),
        kept AS (SELECT DISTINCT doc_id, field_id, example_id, doc_position, field_position, doc_position - field_position AS o FROM hit WHERE words NOT IN (SELECT words FROM hit GROUP BY words HAVING count(DISTINCT doc_id) > 100)),
        new AS (SELECT *, CASE WHEN field_position - lag(field_position) OVER (PARTITION BY doc_id, field_id, o ORDER BY field_position) > 13 THEN 1 ELSE 0 END AS new FROM kept),
        island AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, field_id, o ORDER BY field_position) AS k FROM new),
        run AS (SELECT doc_id, example_id, field_id, min(doc_position) AS start FROM island GROUP BY doc_id, example_id, field_id, o, k HAVING max(field_position) - min(field_position) + 13 >= 50)
        SELECT doc_id, example_id, field_id, rule, min(start) AS start FROM whole GROUP BY 1, 2, 3, 4 UNION ALL SELECT * FROM asked
        UNION ALL SELECT doc_id, example_id, field_id, 'contiguous_token_run', min(start) FROM run GROUP BY 1, 2, 3""",
    "control_panel": """SELECT benchmark_name, field_role, field_id, sha256('panel-v1' || chr(0) || field_id) AS rank FROM benchmark_field WHERE matchable
        QUALIFY row_number() OVER (PARTITION BY benchmark_name, field_role ORDER BY sha256('panel-v1' || chr(0) || field_id), field_id) <= 8""",
    "scan_accounting": "SELECT source, count(*) AS rows, sum(('0x' || substr(sha256(doc_id::VARCHAR), 1, 15))::BIGINT)::VARCHAR AS digest FROM documents GROUP BY source",
}
