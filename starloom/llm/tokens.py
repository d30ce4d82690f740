"""Token counts of texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Session setting that names the vocabulary (a .tiktoken file every executor can read).
VOCABULARY = "spark.starloom.vocabulary"
DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
#: How such a vocabulary splits text before merging bytes (fixed value of the public vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts beyond it are counted in pieces cut before a blank that follows a letter, where no token reaches across.
LONG_TEXT = 200_000


def vocabulary_path(spark: SparkSession) -> str:
    path = spark.conf.get(VOCABULARY, None)
    if not path:
        import public_tokenizers

        path = str(public_tokenizers.path(DEFAULT_VOCABULARY))
    return path


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> Iterator[str]:
    """The text cut into pieces of about LONG_TEXT characters, whose counts add up to that of the text.

    A cut lies between a letter and a blank followed by a letter: there the pattern always starts a
    new match.  Without such a place the piece grows by another LONG_TEXT.
    """
    start, n = 0, len(text)
    while n - start > LONG_TEXT:
        at = start + LONG_TEXT
        while at < n - 1 and not (text[at] == " " and text[at - 1].isalpha() and text[at + 1].isalpha()):
            at += 1
        if at >= n - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


@lru_cache(maxsize=1)
def _splitter():
    import regex

    return regex.compile(PATTERN)


#: A run of blanks on which the library's splitter, which backtracks, would overflow its stack.
_BLANKS = re.compile(r"\s{4000}")


def _length(text: str, path: str) -> int:
    """Tokens of a text; one with an overlong run of blanks is split by another splitter with the same pattern."""
    encoding = _encoding(path)
    if _BLANKS.search(text):
        return sum(len(encoding._encode_single_piece(m.group())) for m in _splitter().finditer(text))
    return len(encoding.encode_ordinary(text))


def count(text: str | None, path: str) -> int:
    if not text:
        return 0
    return _length(text, path) if len(text) <= LONG_TEXT else sum(_length(p, path) for p in pieces(text))


def token_counts(spark: SparkSession, documents: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    """documents without the text, with its number of tokens; 0 for null and empty texts.  Whole texts are counted."""
    path = vocabulary_path(spark)

    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([count(t, path) for t in texts], dtype="int64")

    counted.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(counted, T.LongType())
    return documents.select(*(c for c in documents.columns if c not in (text, out)), udf(F.col(text)).alias(out))
