"""Comparable forms of ids, hashes and labels.

Two values are equal when their letters and digits agree in order after NFC
and case folding; everything else in them is ignored.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def fold_key(value: str | None) -> str | None:
    """The comparable form of one value; NULL stays NULL."""
    if value is None:
        return None
    if value.isascii():
        return "".join(filter(str.isalnum, value)).lower()
    return "".join(filter(str.isalnum, unicodedata.normalize("NFC", value).casefold()))


@F.pandas_udf(StringType())
def _fold_keys(values: pd.Series) -> pd.Series:
    return pd.Series([fold_key(v) if isinstance(v, str) else None for v in values], dtype=object)


def hex_key(value: Column | str) -> Column:
    """Bare lower-case form of an id or hash whose letters are ASCII; stays in the JVM. NULL stays NULL."""
    value = F.col(value) if isinstance(value, str) else value
    return F.lower(F.regexp_replace(value.cast("string"), "[^0-9A-Za-z]+", ""))


def label_key(value: Column | str) -> Column:
    """Comparable form of any value.

    Values whose letters and digits are ASCII are folded in the JVM; only the
    others are sent to Python (as NULLs otherwise, which cost next to nothing).
    """
    value = F.col(value) if isinstance(value, str) else value
    kept = F.regexp_replace(value.cast("string"), r"[^\p{L}\p{M}\p{N}]+", "")
    plain = kept.rlike(r"^[0-9A-Za-z]*$")
    return F.when(value.isNull() | plain, F.lower(kept)).otherwise(_fold_keys(F.when(~plain, value.cast("string"))))


def filled(value: Column | str) -> Column:
    """True when a value is neither NULL nor blank nor ``none`` in any case."""
    value = F.col(value) if isinstance(value, str) else value
    bare = F.lower(F.regexp_replace(value.cast("string"), r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", ""))
    return value.isNotNull() & (bare != "") & (bare != "none")
