"""Bands, strata, flags and labels as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def banded(value: Column | str, bands: Sequence[tuple[float, str]]) -> Column:
    """The name of the last band whose lower bound ``value`` reaches; NULL for NULL and for values below all bands."""
    value = _col(value)
    out = F.lit(None).cast("string")
    for low, name in bands:
        out = F.when(value >= low, name).otherwise(out)
    return out


#: Bounds of all bands. A band reaches from its lower bound to below the next; what lies below the first has none.
STRATA = ((0, "short"), (20, "medium"), (1_000, "long"), (100_000, "giant"))
LENGTHS = ((0, "lt20"), (20, "20_99"), (100, "100_999"), (1_000, "1000_99999"), (100_000, "ge100000"))
SIMILARITIES = ((0.0, "lt0.70"), (0.70, "0.70_0.80"), (0.80, "0.80_0.85"), (0.85, "0.85_0.90"), (0.90, "0.90_0.92"), (0.92, "0.92_0.95"), (0.95, "ge0.95"))
TAILS = ((0.80, "0.80_0.85"), (0.85, "0.85_0.90"), (0.90, "0.90_0.92"), (0.92, "0.92_0.95"), (0.95, "ge0.95"))
RATIOS = ((0.0, "lt0.10"), (0.10, "0.10_0.25"), (0.25, "0.25_0.50"), (0.50, "0.50_0.75"), (0.75, "0.75_0.90"), (0.90, "0.90_1.00"))
BUCKETS = ((2, "2_5"), (6, "6_20"), (21, "21_64"), (65, "65_256"), (257, "gt256"))

#: Labels of scored pairs, proposals for short texts, and reasons to look at a pair.
LABELS = ("containment case", "boilerplate false positive", "true duplicate", "probable duplicate", "related but distinct", "ambiguous")
ACTIONS = ("preserve_all_diagnostic", "exact_only_or_diagnostic", "review_only", "normal_candidate_generation")
CATEGORIES = (
    "similarity_boundary", "high_exact_jaccard", "cross_source", "same_domain", "boilerplate_suspect", "containment", "curated_web", "web_web", "carolina_wikipedia", "gutenberg_web",
    "short_text", "giant_document", "parlamento_diagnostic_only",
)


def length_stratum(words: Column | str) -> Column:
    return banded(words, STRATA)


def length_band(words: Column | str) -> Column:
    return banded(words, LENGTHS)


def similarity_band(similarity: Column | str) -> Column:
    return banded(similarity, SIMILARITIES)


def tail_band(similarity: Column | str) -> Column:
    return banded(similarity, TAILS)


def ratio_band(ratio: Column | str) -> Column:
    return banded(ratio, RATIOS)


def bucket_band(size: Column | str) -> Column:
    return banded(size, BUCKETS)


def ratio(a: Column | str, b: Column | str) -> Column:
    """Smaller by larger; 1 when both are 0, NULL when one is NULL."""
    a, b = _col(a), _col(b)
    high = F.greatest(a, b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(high == 0, 1.0).otherwise(F.least(a, b) / high)


def relation(source_a: Column | str, source_b: Column | str) -> Column:
    return F.when(_col(source_a).eqNullSafe(_col(source_b)), "within_source").otherwise("cross_source")


def source_subset(source: Column | str, subset: Column | str) -> Column:
    return F.concat_ws("/", _col(source), _col(subset))


def unordered_pair(a: Column | str, b: Column | str) -> Column:
    """One name for a pair in either order."""
    return F.concat_ws(" | ", F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b)))


def containment_flags(containment: Column | str, jaccard: Column | str, length_ratio: Column | str, shared: Column | str) -> Column:
    """Which of three rules say that one text lies within another."""
    c, j, r, s = map(_col, (containment, jaccard, length_ratio, shared))
    return F.array_compact(
        F.array(
            F.when((c >= 0.9) & (j < 0.8), "high_containment"),
            F.when((c >= 0.95) & (r < 0.5), "short_in_long"),
            F.when((s >= 100) & (j < 0.8), "large_overlap"),
        )
    )


def boilerplate_suspect(jaccard: Column | str, title_jaccard: Column | str, head_a: Column | str, head_b: Column | str) -> Column:
    """Alike texts whose titles and first 300 characters differ; a pair without both titles is no suspect."""
    a, b = (F.lower(F.substring(_col(x), 1, 300)) for x in (head_a, head_b))
    return F.coalesce((_col(jaccard) >= 0.8) & (_col(title_jaccard) < 0.2) & (a != b), F.lit(False))


def short_action(words: Column | str, preserved: Column | str) -> Column:
    """What may be done about a pair whose shorter text has so many words; pairs with a preserved source are only diagnosed."""
    preserve, exact, review, normal = ACTIONS
    words = _col(words)
    return F.when(_col(preserved), preserve).when(words < 20, exact).when(words < 100, review).otherwise(normal)


def provisional_label(
    jaccard: Column | str, containment: Column | str, distinctive: Column | str, common_share: Column | str, length_ratio: Column | str, related: Column | str, preserved: Column | str
) -> Column:
    """The first rule that holds for a scored pair.

    ``containment`` is the larger of both directions, ``distinctive`` the
    Jaccard similarity on rare n-grams, ``common_share`` the frequent part of
    what is shared, ``related`` whether titles or hosts agree. Pairs of
    preserved sources, and pairs without a score, are never labelled.
    """
    contained, boilerplate, true, probable, related_only, unclear = LABELS
    j, c, d, m, r = map(_col, (jaccard, containment, distinctive, common_share, length_ratio))
    return (
        F.when(_col(preserved) | j.isNull(), unclear)
        .when((c >= 0.9) & (j < 0.5), contained)
        .when((j >= 0.75) & ((d < 0.3) | (m >= 0.75)), boilerplate)
        .when((j >= 0.9) & (r >= 0.7) & (d >= 0.7), true)
        .when((j >= 0.75) & (r >= 0.5) & (d >= 0.5), probable)
        .when(_col(related), related_only)
        .otherwise(unclear)
    )


def review_categories(pair: dict[str, Column]) -> Column:
    """Every reason why a pair is worth a look.

    ``pair`` holds ``boundary, jaccard, source_a, source_b, host_a, host_b,
    boilerplate, flags, words_a, words_b``; sources in comparable form.
    """
    a, b = pair["source_a"], pair["source_b"]
    curated = ("carolina", "wikipediapt", "gutenbergpt")
    web_a, web_b = a.eqNullSafe(F.lit("gigaverbov2")), b.eqNullSafe(F.lit("gigaverbov2"))

    def either_way(x: str, y: str) -> Column:
        return ((a == x) & (b == y)) | ((a == y) & (b == x))

    holds = (
        pair["boundary"], pair["jaccard"] >= 0.8, ~a.eqNullSafe(b), pair["host_a"] == pair["host_b"], pair["boilerplate"], F.size(pair["flags"]) > 0,
        (a.isin(*curated) & web_b) | (b.isin(*curated) & web_a), web_a & web_b, either_way("carolina", "wikipediapt"), either_way("gutenbergpt", "gigaverbov2"),
        F.least(pair["words_a"], pair["words_b"]) < 20, F.greatest(pair["words_a"], pair["words_b"]) >= 100_000, (a == "parlamentopt") | (b == "parlamentopt"),
    )
    return F.array_compact(F.array(*[F.when(h, name) for h, name in zip(holds, CATEGORIES, strict=True)]))
