"""Raw records to normalized documents, with every reject told."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import filled
from ..functions.text import content_hash, normalized_text
from ..schema import NORMALIZED_SCHEMA

VERSION = "normalization-v1"


def empty_to_null(value: Column | str) -> Column:
    """NULL for blank values and ``none``, else the value without white space at its ends."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(filled(value), F.trim(value))


def normalize_records(raw: DataFrame, extra: str = "upstream_metadata_json") -> tuple[DataFrame, DataFrame]:
    """Normalized documents, and rejects with their reasons.

    Columns of the normalized schema that ``raw`` lacks are NULL; columns it
    has besides are folded into ``extra`` as one JSON object in the order of
    their names. Scores that are no numbers are NULL.

    * NULL or blank text, or NULL source: a reject with ``reasons``.
    * Repeated rows are kept as they are. Empty input: both empty.
    """
    known = set(NORMALIZED_SCHEMA.fieldNames())
    have = set(raw.columns)
    others = sorted(have - known)
    text = normalized_text("text")
    columns = {}
    for f in NORMALIZED_SCHEMA:
        kind = f.dataType.simpleString()
        if f.name == "text":
            columns[f.name] = text
        elif f.name == "content_sha256":
            columns[f.name] = content_hash("text")
        elif f.name == "normalization_version":
            columns[f.name] = F.lit(VERSION)
        elif f.name not in have:
            columns[f.name] = F.lit(None).cast(kind)
        elif kind == "string":
            columns[f.name] = empty_to_null(F.col(f.name).cast("string"))
        else:
            columns[f.name] = F.expr(f"try_cast(`{f.name}` AS {kind})")
    if others:
        folded = F.to_json(F.struct(*others))
        columns[extra] = F.coalesce(columns[extra], folded) if extra in have else folded
    reasons = F.array_compact(F.array(F.when(F.coalesce(text, F.lit("")) == "", "blank_text"), F.when(~F.coalesce(filled(F.col("source")), F.lit(False)), "no_source")))
    marked = raw.select(*[c.alias(n) for n, c in columns.items()], reasons.alias("reasons"))
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def row_errors() -> Column:
    """Names of all rules of the normalized row that a row breaks."""
    checks = [
        ("text_missing", F.col("text").isNull() | (F.col("text") == "")),
        ("text_not_normalized", F.coalesce(F.col("text") != normalized_text("text"), F.lit(False))),
        ("source_missing", ~F.coalesce(filled("source"), F.lit(False))),
        ("hash_malformed", ~F.coalesce(F.col("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))),
        ("hash_wrong", F.coalesce(F.col("content_sha256") != content_hash("text"), F.lit(False))),
        ("score_out_of_range", F.coalesce(~F.col("language_score").between(0, 1), F.lit(False))),
    ]
    return F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks]))


def error_counts(documents: DataFrame) -> DataFrame:
    """``(error, rows)`` for every rule that is broken."""
    return documents.select(F.explode_outer(row_errors()).alias("error")).where(F.col("error").isNotNull()).groupBy("error").agg(F.count(F.lit(1)).alias("rows"))


def long_enough(documents: DataFrame, characters: int) -> DataFrame:
    """Documents of so many characters or more, white space at the ends left out."""
    return documents.where(F.length(F.trim("text")) >= characters)


def titled(title: Column | str, text: Column | str) -> Column:
    """The text with its title before it, unless it begins with the title."""
    title, text = (F.col(x) if isinstance(x, str) else x for x in (title, text))
    return F.when(filled(title) & ~F.coalesce(F.startswith(text, title), F.lit(False)), F.concat_ws("\n\n", title, text)).otherwise(text)


def glob_pattern(glob: str) -> str:
    """A shell pattern (*, ?, sets) as a Java pattern for the whole value, case ignored."""
    import fnmatch
    import re

    inner = fnmatch.translate(glob)
    inner = re.sub(r"^\(\?s:(.*)\)\\[Zz]$", r"\1", inner, flags=re.S)
    return f"(?is)^(?:{inner})$"


def exclusion_rule(subset: Column | str, blocked: Sequence[str], patterns: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Why a subset is excluded: ``blocked`` for an exact name, else the first rule with a matching pattern, else NULL.

    ``patterns`` are (rule, shell patterns) in the order in which they are tried. A NULL subset is not excluded.
    """
    subset = F.col(subset) if isinstance(subset, str) else subset
    out = F.when(subset.isNull(), F.lit(None).cast("string"))
    if blocked:
        out = out.when(subset.isin(*blocked), "blocked")
    for rule, globs in patterns:
        out = out.when(F.coalesce(subset.rlike("|".join(glob_pattern(g) for g in globs)), F.lit(False)), rule)
    return out
