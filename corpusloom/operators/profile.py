"""Measures of a collection: sizes, distributions, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import filled
from ..functions.text import content_hash, letters, repeated_line_ratio, strip, word_count

#: Below these a document is nearly empty; from this share on its lines repeat.
NEAR_EMPTY_CHARACTERS, NEAR_EMPTY_WORDS, HIGH_REPETITION = 100, 20, 0.2
#: Word counts from which documents are counted.
THRESHOLDS = (20, 50, 100, 500, 1_000, 10_000, 100_000)


def measured(documents: DataFrame) -> DataFrame:
    """``documents`` with ``characters, words, letters, repeated_lines``; NULL texts count as empty."""
    return documents.withColumns(
        {
            "characters": F.coalesce(F.length("text"), F.lit(0)).cast("long"),
            "words": word_count("text"),
            "letters": letters("text"),
            "repeated_lines": repeated_line_ratio("text"),
        }
    )


def corpus_profile(documents: DataFrame, by: Sequence[str]) -> DataFrame:
    """Documents, sizes, letters per character, nearly empty documents, repeating lines, distinct contents and surplus copies of them (within the group) by the given columns."""
    near_empty = (F.col("characters") < NEAR_EMPTY_CHARACTERS) | (F.col("words") < NEAR_EMPTY_WORDS)
    rows = measured(documents).withColumn("__h", content_hash("text"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("characters").alias("characters"),
        F.sum("words").alias("words"),
        F.round(F.coalesce(F.sum("letters") / F.nullif(F.sum("characters"), F.lit(0)), F.lit(0.0)), 6).alias("letter_ratio"),
        F.count_if(near_empty).alias("near_empty"),
        F.count_if(F.col("repeated_lines") >= HIGH_REPETITION).alias("repeating"),
        F.count_distinct("__h").alias("contents"),
        (F.count("__h") - F.count_distinct("__h")).alias("surplus_copies"),
    )


def percentile(value: str, p: float) -> Column:
    """Nearest rank: the value at place ceil(p n) of the sorted values; exact."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})")


def length_percentiles(documents: DataFrame, by: Sequence[str], value: str = "words", points: Sequence[float] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Nearest-rank percentiles, least, greatest and number of values.

    Percentiles come from counts of distinct values, so a group is reduced to
    its distinct lengths before anything is shuffled by group.
    """
    counts = documents.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by).orderBy(value)
    running = counts.withColumn("__upto", F.sum("__n").over(w)).withColumn("__all", F.sum("__n").over(Window.partitionBy(*by)))
    picks = [F.min(F.when(F.col("__upto") >= F.ceil(F.lit(p) * F.col("__all")), F.col(value))).alias(f"p{round(p * 100)}") for p in points]
    return running.groupBy(*by).agg(F.max("__all").alias("documents"), F.min(value).alias("least"), *picks, F.max(value).alias("greatest"))


def threshold_counts(documents: DataFrame, by: Sequence[str], thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """Documents with at least so many words."""
    return documents.groupBy(*by).agg(*[F.count_if(F.col("words") >= t).alias(f"ge_{t}") for t in thresholds])


def word_shares(documents: DataFrame) -> DataFrame:
    """Each source's and each source and subset's share of all words, rounded to 12 places."""
    sums = documents.groupingSets([["source"], ["source", "subset"]], "source", "subset").agg(
        F.when(F.grouping_id() == 1, "source").otherwise("subset").alias("scope"), F.sum("words").alias("words")
    )
    whole = documents.agg(F.sum("words").alias("__all"))
    shared = sums.crossJoin(F.broadcast(whole))  # one row
    return shared.select("source", "subset", "scope", "words", F.round(F.col("words") / F.nullif(F.col("__all"), F.lit(0)), 12).alias("share"))


def coverage(documents: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """How many values of each column are filled: NULL, blank and ``none`` are not. One row a group and column."""
    wide = documents.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), *[F.count_if(filled(c)).alias(f"__{c}") for c in columns])
    pairs = ", ".join(f"'{c}', `__{c}`" for c in columns)
    return wide.select(*by, "documents", F.expr(f"stack({len(columns)}, {pairs}) AS (field, filled)")).withColumn(
        "missing_rate", F.round((F.col("documents") - F.col("filled")) / F.col("documents"), 6)
    )


def top_values(documents: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value; NULLs are left out."""
    counts = documents.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("documents"))
    return counts.orderBy(F.desc("documents"), column).limit(n)


def outliers(documents: DataFrame, by: str, key: str) -> DataFrame:
    """For each group its longest document, its median ``sorted[n // 2]`` and its ``sorted[int(0.9 n)]`` of words."""
    counts = documents.groupBy(by, "words").agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__k"))
    w = Window.partitionBy(by).orderBy("words")
    run = counts.withColumn("__upto", F.sum("__n").over(w)).withColumn("__all", F.sum("__n").over(Window.partitionBy(by)))

    def place(at: Column) -> Column:
        return F.min(F.when(F.col("__upto") > at, F.col("words")))

    return run.groupBy(by).agg(
        F.max("__all").alias("documents"),
        place(F.floor(F.col("__all") / 2)).alias("median_words"),
        place(F.expr("(__all * 9) div 10")).alias("p90_words"),
        F.max("words").alias("most_words"),
        F.max_by("__k", "words").alias("longest"),
    )


def repeated_contents(documents: DataFrame, n: int) -> DataFrame:
    """The n contents that occur most often, ties by hash."""
    counts = documents.where(F.col("content_sha256").isNotNull()).groupBy("content_sha256").agg(F.count(F.lit(1)).alias("records"), F.max("words").alias("words"))
    return counts.where(F.col("records") > 1).orderBy(F.desc("records"), "content_sha256").limit(n)


#: How speakers are introduced, and interjections of the record.
SPEAKERS = ("o sr.", "o sr ", "a sr.", "a sr ", "o senhor", "a senhora", "sr. presidente", "sra. presidente", "presidente:", "o presidente:")
INTERJECTIONS = ("apoiado", "muito bem", "palmas", "risas", "pausa", "interrupção", "protesto", "vozes", "nao apoiado", "não apoiado", "não!", "sim!")
#: What marks collected works, as a pattern for any case.
ANTHOLOGY = (
    r"\bobras completas\b|\bobras escolhidas\b|\bcoletânea\b|\bantologia\b|\bvolume\s+[ivxlcdm0-9]+\b|\btomo\s+[ivxlcdm0-9]+\b"
    r"|\b(?:primeira|segunda|terceira)\s+parte\b|\bpart\s+(?:i|ii|iii|iv|v|vi|vii|viii)\b"
)


def formula_category(text: Column | str) -> Column:
    """What kind of parliamentary text this is: the first rule that holds; NULL counts as empty, which is a short formula.

    Texts of up to five words that hold an interjection are procedural, longer
    ones only if they are one or begin with one as a word.
    """
    text = F.lower(strip(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))
    words = word_count(text)

    def some(tests: Sequence[Column]) -> Column:
        return F.greatest(*tests)

    speaker = some([F.startswith(text, F.lit(p)) for p in SPEAKERS])
    holds = some([F.contains(text, F.lit(p)) for p in INTERJECTIONS])
    opens = some([(text == p) | F.startswith(text, F.lit(f"{p} ")) for p in INTERJECTIONS])
    few = words <= 5
    return (
        F.when(few & holds, "procedural_utterance")
        .when(speaker, "speaker_label")
        .when(few, "short_formula")
        .when(opens, "procedural_utterance")
        .when(words > 200, "unexpectedly_long_repetition")
        .otherwise("parliamentary_formula")
    )


def outlier_class(text: Column | str) -> Column:
    """Why a text is unusually large: collected works by their marks in the first 5,000 characters, a first part that comes again, plain length, or unknown; NULL for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    n = F.length(text)
    again = (n > 10_000) & F.contains(F.substr(text, (F.floor(n / 4) * 2 + 1).cast("int")), F.substring(text, 1, 500))
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(F.substring(text, 1, 5000).rlike(f"(?iU)(?:{ANTHOLOGY})"), "collected_works_or_anthology")
        .when(again, "duplicated_concatenation")
        .when(word_count(text) > 100_000, "legitimate_very_large_text")
        .otherwise("unknown_outlier")
    )
