"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Folder and file of the default vocabulary; both are parameters.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Fixed value: the pattern that cuts texts before byte pairs are merged, as published with the vocabulary.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=4)
def _encoder(path: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens of a batch; one loaded vocabulary a worker."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(coder.encode_ordinary(t)) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in plain.encode_batch(texts, add_special_tokens=False)]


def public_tokens(text: Column | str, vocabulary: str = VOCABULARY, folder: str = FOLDER) -> Column:
    """Number of tokens of each text in a public vocabulary; NULL and empty texts have 0. Special tokens in a text are ordinary text."""
    path = f"{folder}/{vocabulary}"

    def count(texts: pd.Series) -> pd.Series:
        present = [t if isinstance(t, str) else "" for t in texts]
        return pd.Series(_encoder(path)(present), dtype="int64")

    return F.pandas_udf(count, LongType())(text)


def white_space_tokens(text: Column | str) -> Column:
    """Number of pieces parted by Unicode white space; NULL and blank texts have 0. Stays in the JVM."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\s\p{Z}\x85\x1c-\x1f]+")), F.lit(0)).cast("long")
