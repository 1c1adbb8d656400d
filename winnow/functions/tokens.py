"""Texts cut to a budget of BPE tokens. The vocabulary is a file of ranks that every machine can read."""

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import blank


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """The encoding of a file of ``base64 rank`` lines with its pre-token pattern; no special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(text: str, tokens: int, path: str, pattern: str) -> str:
    """The text, or what its first ``tokens`` tokens decode to if it has more."""
    enc = encoder(path, pattern)
    found = enc.encode_ordinary(text)
    return text if len(found) <= tokens else enc.decode(found[:tokens])


def token_budget(text: Column, tokens: int, path: str, pattern: str) -> Column:
    """At most the first ``tokens`` tokens of the text; null is empty."""

    @F.pandas_udf(T.StringType())
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([cut(t, tokens, path, pattern) for t in s], dtype=object)

    return column(blank(text))
