"""Joins that Spark has no word for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import content_hash, normalized_text
from .current import latest_rows


def containing_range(points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, start: str, take: Sequence[str], cell: int) -> DataFrame:
    """Each point with columns of the last range that starts at or before it (as a bisection of starts would find).

    Points and starts are cut into cells of ``cell`` numbers; within a cell a
    window carries the last start forward, and what a cell begins with comes
    from the last start of earlier cells. No range is compared with every
    point, and no key's rows stand in one task.

    Points before the first start, and NULL points, get NULLs. Equal starts: the larger taken columns.
    """
    keys = list(keys)
    own = F.struct(start, *take)
    r = ranges.where(F.col(start).isNotNull()).select(*keys, F.expr(f"{start} div {cell}L").alias("__cell"), own.alias("__r"))
    r = r.groupBy(*keys, "__cell", F.col(f"__r.{start}").alias("__at")).agg(F.max("__r").alias("__r"))
    lasts = r.groupBy(*keys, "__cell").agg(F.max("__r").alias("__last"))
    p = points.withColumn("__cell", F.expr(f"{at} div {cell}L"))
    cells = p.select(*keys, "__cell").distinct().join(lasts, [*keys, "__cell"], "full")
    w = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    begin = cells.select(*keys, "__cell", F.last("__last", ignorenulls=True).over(w).alias("__begin"))
    names = points.columns
    marked = p.select(*keys, "__cell", F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(*names).alias("__p"), F.lit(None).cast(dict(r.dtypes)["__r"]).alias("__r"))
    both = marked.unionByName(r.select(*keys, "__cell", "__at", F.lit(0).alias("__side"), F.lit(None).cast(dict(marked.dtypes)["__p"]).alias("__p"), "__r"))
    inside = Window.partitionBy(*keys, "__cell").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__f", F.last("__r", ignorenulls=True).over(inside)).where("__side = 1").join(begin, [*keys, "__cell"], "left")
    best = F.coalesce("__f", "__begin")
    return found.select(*[F.col(f"__p.{c}").alias(c) for c in names], *[best[c].alias(c) for c in take])


def kth_with_kth(left: DataFrame, right: DataFrame, keys: Sequence[str], order_left: Sequence[str], order_right: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Joins the k-th row of a key on the left with its k-th row on the right; NULL keys equal one another.

    For occurrences that have no id but their place among equals.
    """
    names = list(keys)
    l = left.withColumn("__k", F.row_number().over(Window.partitionBy(*names).orderBy(*order_left)))
    r = right.withColumn("__k", F.row_number().over(Window.partitionBy(*names).orderBy(*order_right)))
    r = r.select(*[F.col(n).alias(f"__key_{n}") for n in names], F.col("__k").alias("__j"), *take)
    match = F.col("__k") == F.col("__j")
    for n in names:
        match = match & F.col(n).eqNullSafe(F.col(f"__key_{n}"))
    return l.join(r, match).select(*left.columns, *take)


def differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of one relation that the other lacks, with multiplicity: the row and ``side`` (``unexpected`` or ``missing``)."""
    names = expected.columns
    a, e = actual.select(*names), expected.select(*names)
    return a.exceptAll(e).withColumn("side", F.lit("unexpected")).unionByName(e.exceptAll(a).withColumn("side", F.lit("missing")))


def undone(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is left to do after a restart: rows whose key is not in ``done``; NULL keys are always left."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def field_differences(rows: DataFrame, known: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``(field, compared, differing)``: rows against the known row of the same key, field by field, NULL equal to NULL; ``no_record`` counts rows that have none.

    ``known`` has one row a key. NULL keys have no known row.
    """
    other = known.select(F.col(key), *[F.col(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__known"))
    both = rows.select(key, *fields).join(other, key, "left")
    have = F.coalesce("__known", F.lit(False))
    counts = both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(have).alias("have"), *[F.count_if(have & ~F.col(f).eqNullSafe(F.col(f"__{f}"))).alias(f"d_{f}") for f in fields])
    told = F.array(F.struct(F.lit("no_record").alias("field"), F.col("rows").alias("compared"), (F.col("rows") - F.col("have")).alias("differing")),
                   *[F.struct(F.lit(f).alias("field"), F.col("have").alias("compared"), F.col(f"d_{f}").alias("differing")) for f in fields])
    return counts.select(F.inline(told))


def late_texts(chosen: DataFrame, texts: DataFrame, key: str, stamp: str, told: str) -> DataFrame:
    """Chosen rows with the length of their current text and whether its hash is the one told for it: ``chosen columns, characters, hash_right``.

    The choice is a semi-join before any text moves, so texts are read for
    chosen keys alone. Chosen rows without a text have no row.
    """
    wanted = texts.join(chosen.select(key).distinct(), key, "left_semi")
    current = latest_rows(wanted, [key], stamp, [told])
    checked = current.select(key, F.coalesce(F.length(normalized_text("text")), F.lit(0)).cast("long").alias("characters"), content_hash("text").eqNullSafe(F.nullif(told, F.lit(""))).alias("hash_right"))
    return chosen.join(checked, key)
