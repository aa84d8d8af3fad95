"""How a tokenizer breaks up words: metrics of texts by stratum, source and over all."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions.text import accented_words, lexical_words, number_spans, punctuation_count, scientific_spans, word_count

#: Fixed value: words at most this often in a set are rare.
RARE = 2


@lru_cache(maxsize=4)
def _pieces(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


def token_count(text: Column | str, path: str) -> Column:
    """Tokens of each text under the vocabulary file at ``path``; NULL and empty texts have 0."""

    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(_pieces(path)([t if isinstance(t, str) else "" for t in texts]), dtype="int32")

    return F.pandas_udf(count, IntegerType())(text)


def word_pieces(documents: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """``(by..., word, occurrences, pieces)`` for every distinct lexical word of a group.

    Words are counted before they are tokenized, so each distinct word of a
    group is tokenized once.
    """
    words = documents.select(*by, F.explode_outer(lexical_words("text")).alias("word")).where(F.col("word").isNotNull()).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("occurrences"))
    return words.withColumn("pieces", token_count("word", path))


def fragmentation(documents: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Tokens per word, nearest-rank percentiles of pieces over all occurrences of words, the most pieces of a word, and pieces of accented and rare words, by the given columns."""
    texts = documents.withColumn("tokens", token_count("text", path)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"), F.sum(word_count("text")).alias("words"),
        F.sum(F.size(number_spans("text"))).alias("numbers"), F.sum(F.size(scientific_spans("text"))).alias("scientific"),
        F.sum(punctuation_count("text")).alias("punctuation"), F.sum(F.size(accented_words("text"))).alias("accented"),
    )
    pieces = word_pieces(documents, path, by)
    n, t = F.col("occurrences"), F.col("occurrences") * F.col("pieces")
    accent, rare = F.col("word").rlike(r"[^\x00-\x7f]"), F.col("occurrences") <= RARE
    told = pieces.groupBy(*by).agg(
        F.max("pieces").alias("most_pieces"),
        F.round(F.sum(F.when(accent, t)) / F.sum(F.when(accent, n)), 6).alias("pieces_per_accented_word"),
        F.round(F.sum(F.when(rare, t)) / F.sum(F.when(rare, n)), 6).alias("pieces_per_rare_word"),
    )
    counts = pieces.groupBy(*by, "pieces").agg(F.sum("occurrences").alias("__n"))
    w = Window.partitionBy(*by)
    run = counts.withColumn("__upto", F.sum("__n").over(w.orderBy("pieces"))).withColumn("__all", F.sum("__n").over(w))
    ranks = [F.min(F.when(F.col("__upto") >= F.ceil(F.lit(p) * F.col("__all")), F.col("pieces"))).alias(f"pieces_p{round(p * 100)}") for p in (0.5, 0.9, 0.99)]
    ranks = run.groupBy(*by).agg(*ranks)
    told = told.join(ranks, list(by), "left") if by else told.crossJoin(F.broadcast(ranks))  # one row each
    out = texts.join(told, list(by), "left") if by else texts.crossJoin(F.broadcast(told))
    return out.withColumn("tokens_per_word", F.round(F.col("tokens") / F.nullif(F.col("words"), F.lit(0)), 6))


def compare(documents: DataFrame, paths: dict[str, str], by: Sequence[str]) -> DataFrame:
    """:func:`fragmentation` of several vocabularies side by side, ``candidate`` first; none is declared the best. Names must be distinct, an empty choice is an error."""
    if not paths:
        raise ValueError("there is nothing to compare")
    parts = [fragmentation(documents, path, by).select(F.lit(name).alias("candidate"), "*") for name, path in sorted(paths.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def macro_average(metrics: DataFrame, value: str, source: str = "source") -> DataFrame:
    """Unweighted mean over sources of each source's mean; NULLs are left out at both levels."""
    return metrics.groupBy(source).agg(F.avg(value).alias("__m")).agg(F.round(F.avg("__m"), 6).alias(f"macro_{value}"), F.count("__m").alias("sources"))
