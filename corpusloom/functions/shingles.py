"""Word n-grams, set similarity and MinHash as column expressions."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

#: Modulus of the portable MinHash family; products of two residues fit a signed 64-bit number.
PRIME = 2**31 - 1


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ngrams(words: Column | str, n: int) -> Column:
    """All runs of n adjacent words joined by blanks, in order; none for shorter texts.

    Shifted copies of the array are zipped, so the array is read n times and
    not once for every position. ``words`` should be a column of its own:
    as an expression it would be evaluated for every copy.
    """
    words = _col(words)
    count = F.greatest(F.size(words) - (n - 1), F.lit(0))
    shifted = [F.slice(words, k + 1, count).alias(f"w{k}") for k in range(n)]
    return F.transform(F.arrays_zip(*shifted), lambda x: F.concat_ws(" ", *[x[f"w{k}"] for k in range(n)]))


def shingle_set(words: Column | str, n: int) -> Column:
    """Distinct word n-grams; fewer words than n are one shingle of their own, marked so that it equals no n-gram; no words, no shingle."""
    words = _col(words)
    whole = F.array(F.concat(F.lit("short\0"), F.array_join(words, " ")))
    return F.when(F.size(words) >= n, F.array_distinct(ngrams(words, n))).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared by all elements of two sets; 0 when both are empty."""
    a, b = _col(a), _col(b)
    shared = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - shared
    return F.when(whole > 0, shared / whole).otherwise(0.0)


def containment(a: Column | str, b: Column | str) -> Column:
    """Share of the smaller set that lies in the other; 0 when it is empty."""
    a, b = _col(a), _col(b)
    low = F.least(F.size(a), F.size(b))
    return F.when(low > 0, F.size(F.array_intersect(a, b)) / low).otherwise(0.0)


def portable_coefficients(permutations: int, label: str = "minhash-v1") -> list[tuple[int, int]]:
    """(a, b) of each permutation of the portable family, from hashed labels."""
    out = []
    for p in range(permutations):
        d = hashlib.sha256(f"{label}:{p}".encode()).digest()
        out.append((int.from_bytes(d[:8], "big") % (PRIME - 1) + 1, int.from_bytes(d[8:16], "big") % PRIME))
    return out


def portable_hash(value: Column) -> Column:
    """First 32 bits of SHA-256 below the modulus; SQL engines agree on it."""
    return F.conv(F.substring(F.sha2(value, 256), 1, 8), 16, 10).cast("long") % PRIME


def portable_hashes(shingles: Column | str) -> Column:
    """Hashes of a set in the portable family; SQL engines agree on them."""
    return F.transform(_col(shingles), portable_hash)


def portable_minhash(hashes: Column | str, permutations: int, label: str = "minhash-v1") -> Column:
    """Signature in the portable family from a column of hashes, computed in the JVM; NULL for empty sets."""
    hashes = _col(hashes)

    def least(a: int, b: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: (h * a + b) % PRIME))

    minima = [least(a, b) for a, b in portable_coefficients(permutations, label)]
    return F.when(F.size(hashes) > 0, F.array(*minima))


def fast_minhash(shingles: Column | str, permutations: int = 128, seed: int = 1) -> Column:
    """Signature over 64-bit xxh64 values and multiply-add permutations, in Arrow batches; NULL for empty sets. Values are unsigned numbers kept as signed ones."""

    def run(sets: pd.Series) -> pd.Series:
        draw = np.random.default_rng(seed)
        a = draw.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = draw.integers(0, 2**63, permutations, dtype=np.uint64)
        out = []
        for s in sets:
            if s is None or len(s) == 0:
                out.append(None)
                continue
            h = np.fromiter((xxhash.xxh64_intdigest(x) for x in s), dtype=np.uint64, count=len(s))
            least = np.full(permutations, np.iinfo(np.uint64).max, dtype=np.uint64)
            for i in range(0, len(h), 4096):  # bounded memory for very long texts
                least = np.minimum(least, (a[:, None] * h[None, i : i + 4096] + b[:, None]).min(axis=1))
            out.append(least.view(np.int64))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, ArrayType(LongType()))(_col(shingles))


def signature_similarity(a: Column | str, b: Column | str) -> Column:
    """Share of equal positions; 0 for empty, NULL for NULL signatures."""
    a, b = _col(a), _col(b)
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(F.size(a) > 0, same / F.size(a)).otherwise(0.0)


def band_keys(signature: Column | str, bands: int, rows: int, label: str = "band-v1") -> Column:
    """One key a band: hex SHA-256 of the band's number and its rows."""
    signature = _col(signature)

    def key(i: Column) -> Column:
        part = F.slice(signature, i * rows + 1, rows)
        return F.sha2(F.concat_ws(":", F.lit(label), i.cast("string"), F.array_join(F.transform(part, lambda x: x.cast("string")), ",")), 256)

    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)
