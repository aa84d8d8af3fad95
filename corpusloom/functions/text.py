"""Text normalization, words, tokens and text statistics.

Three kinds of words exist side by side: white-space separated words (the unit
of all accounting), shingle words (letters, numerals and underscores) and match
tokens (letters and numerals with attached marks, case folded, with offsets).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Every character that counts as white space, and the class of them for Java patterns.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CLASS = r"\s\p{Z}\x1c-\x1f\x85"

#: Text made of these characters alone is in NFC whatever their order: nothing in them composes or decomposes.
_INERT = r"^[\x00-\x{2ff}\x{2002}-\x{20cf}\x{2100}-\x{2125}\x{2190}-\x{2328}]*$"

TOKEN = StructType([StructField("token", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
_MATCH = regex.compile(r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return pd.Series([unicodedata.normalize("NFC", t) if isinstance(t, str) else None for t in texts], dtype=object)


def nfc(text: Column | str) -> Column:
    """Unicode NFC. Texts of characters that NFC leaves alone never leave the JVM."""
    text = _col(text)
    inert = text.isNull() | text.rlike(_INERT)
    return F.when(inert, text).otherwise(_nfc(F.when(~inert, text)))


def canonical_newlines(text: Column | str) -> Column:
    """CRLF and CR become LF."""
    return F.regexp_replace(_col(text), r"\r\n?", "\n")


def strip(text: Column | str) -> Column:
    """Without white space at either end, in the wide Unicode sense."""
    return F.btrim(_col(text), F.lit(WHITE_SPACE))


def normalized_text(text: Column | str) -> Column:
    """LF line ends, NFC, no white space at the ends. NULL stays NULL."""
    return strip(nfc(canonical_newlines(text)))


def content_hash(text: Column | str) -> Column:
    """Lower-case hex SHA-256 of the normalized text; NULL for NULL and for texts that are empty then."""
    clean = normalized_text(text)
    return F.when(clean != "", F.sha2(clean, 256))


def word_count(text: Column | str) -> Column:
    """Number of white-space separated words; NULL has 0."""
    return F.coalesce(F.regexp_count(_col(text), F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def shingle_words(text: Column | str) -> Column:
    """Runs of letters, numerals and underscores, lower case, accents kept. NULL has none."""
    return F.regexp_extract_all(F.coalesce(F.lower(_col(text)), F.lit("")), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def lexical_words(text: Column | str) -> Column:
    """Runs of letters, joined by apostrophes or hyphens inside."""
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(r"(\p{L}+(?:['’-]\p{L}+)*)"), F.lit(1))


def fold_match(text: str) -> str:
    """NFC and case folding, the form in which tokens are compared."""
    return unicodedata.normalize("NFC", text).casefold()


def iter_match_tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Letters and numerals with their marks, folded, and their places in the text as it came."""
    for m in _MATCH.finditer(text):
        yield fold_match(m.group()), m.start(), m.end()


def raw_match_tokens(text: str) -> list[str]:
    """Match tokens as they stand in the text, not folded."""
    return _MATCH.findall(text)


@F.pandas_udf(ArrayType(TOKEN))
def match_tokens_with_offsets(texts: pd.Series) -> pd.Series:
    """Match tokens with character offsets; NULL has none."""
    return pd.Series([[{"token": w, "start": a, "end": b} for w, a, b in iter_match_tokens(t)] if isinstance(t, str) else [] for t in texts], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def match_tokens(texts: pd.Series) -> pd.Series:
    """Match tokens alone; NULL has none."""
    return pd.Series([[fold_match(w) for w in _MATCH.findall(t)] if isinstance(t, str) else [] for t in texts], dtype=object)


def lines(text: Column | str) -> Column:
    """Lines without white space at their ends, blank ones left out."""
    return F.filter(F.transform(F.split(canonical_newlines(_col(text)), "\n"), strip), lambda x: x != "")


def repeated_line_ratio(text: Column | str) -> Column:
    """Share of lines that repeat an earlier line; 0 without lines."""
    own = lines(text)
    n = F.size(own)
    return F.when(n > 0, (n - F.size(F.array_distinct(own))) / n).otherwise(0.0)


def letters(text: Column | str) -> Column:
    """Number of letters; NULL has 0."""
    return F.coalesce(F.length(F.regexp_replace(_col(text), r"[^\p{L}]+", "")), F.lit(0)).cast("long")


def alphabetic_ratio(text: Column | str) -> Column:
    """Letters per character; 0 for NULL and empty texts."""
    n = F.length(_col(text))
    return F.when(n > 0, letters(text) / n).otherwise(0.0)


def title_tokens(title: Column | str) -> Column:
    """Distinct lower-case words of a title."""
    return F.array_distinct(shingle_words(title))


def normalized_title(title: Column | str, least_tokens: int = 3, least_characters: int = 12) -> Column:
    """Lower-case words of a title joined by blanks; NULL where they are too few or too short to tell titles apart."""
    words = shingle_words(title)
    joined = F.array_join(words, " ")
    return F.when((F.size(words) >= least_tokens) & (F.length(joined) >= least_characters), joined)


def strip_wrapper(text: Column | str, start: str, end: str) -> Column:
    """What stands between a start line and an end line; the text as it is unless both are there in that order.

    ``start`` and ``end`` are Java patterns that match within one line.
    """
    text = canonical_newlines(text)
    found = F.regexp_extract(text, rf"(?s)^.*?(?m:^[^\n]*(?:{start})[^\n]*$)\n?(.*?)\n?(?m:^[^\n]*(?:{end})[^\n]*$)", 1)
    both = text.rlike(rf"(?s)(?m:^[^\n]*(?:{start})[^\n]*$).*?(?m:^[^\n]*(?:{end})[^\n]*$)")
    return F.when(both, strip(found)).otherwise(text)


def accented_words(text: Column | str) -> Column:
    """White-space words that hold a letter outside ASCII."""
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(rf"([^{SPACE_CLASS}]*[^\x00-\x7f{SPACE_CLASS}&&\p{{L}}][^{SPACE_CLASS}]*)"), F.lit(1))


def number_spans(text: Column | str) -> Column:
    """Numbers with grouping and decimal signs."""
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(r"(\d+(?:[.,]\d+)*)"), F.lit(1))


def scientific_spans(text: Column | str) -> Column:
    """Numbers with an exponent."""
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(r"(\d+(?:[.,]\d+)?[eE][+-]?\d+)"), F.lit(1))


def punctuation_count(text: Column | str) -> Column:
    """Number of punctuation characters; NULL has 0."""
    return F.coalesce(F.regexp_count(_col(text), F.lit(r"\p{P}")), F.lit(0)).cast("long")


def line_stats(text: str | None) -> tuple[int, int, int]:
    """Lines, distinct lines and longest line of one text, for tests and small inputs."""
    own = [x for x in (y.strip() for y in re.split(r"\r\n?|\n", text or "")) if x]
    return len(own), len(set(own)), max(map(len, own), default=0)
