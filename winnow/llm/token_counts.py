"""Exact token counts of a byte-level BPE vocabulary.

Most pre-tokens of a text are themselves vocabulary entries. Which entries
encode alone as one token is proved once, offline, with the tokenizer's own
library; such pre-tokens count one each by a set look-up. Only the rest is merged.
Texts are cut at spaces first, where that cannot cut a pre-token, so that a chunk
seen before costs one look-up.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import body

# White_Space of Unicode, and the byte-level pre-token pattern over it.
_WS = r"\p{White_Space}"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}]+|[" + _WS + r"]+(?![^" + _WS + r"])|[" + _WS + r"]+"
)
#: Characters beyond the basic plane take the library's own path: the two sides may know different Unicode versions there.
ASTRAL = "[" + chr(0x10000) + "-" + chr(0x10FFFF) + "]"
#: White space on both sides of a space, or a space at the end after white space: a pre-token may run over the space there.
WOVEN = "[{0}] (?:[{0}]|\\Z)".format("".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])))
MARKS = ".,;:!?"
CACHE_ENTRIES = 400_000


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_to_char() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    return table | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)}


def prove_whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and encode alone as one token.

    Bounded by the vocabulary's size. Each candidate is encoded by the library;
    nothing is assumed from its being in the vocabulary.
    """
    tok, split = _library(path), regex.compile(PRETOKEN)
    back = {c: b for b, c in byte_to_char().items()}
    found = []
    for piece in tok.get_vocab(with_added_tokens=False):
        try:
            text = bytes(back[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if split.findall(text) == [text]:
            found.append(text)
    return [t for t, e in zip(found, tok.encode_batch(found, add_special_tokens=False), strict=True) if len(e.ids) == 1]


@functools.lru_cache(maxsize=8)
def _proof(path: str, digest: str) -> list[str]:
    """The proof for a file of this content, made once in a process."""
    return prove_whole_tokens(path)


def _word(text: str) -> bool:
    """Letters only, below U+0250, where all Unicode versions agree on what a letter is."""
    return text.isalpha() and (text.isascii() or max(text) < "\u0250")


class _Chunks(dict):
    """Tokens of a space and the chunk after it; each distinct chunk is worked once."""

    def __init__(self, count, merged):
        super().__init__()
        self.count, self.merged = count, merged

    def __missing__(self, chunk: str) -> int:
        if _word(chunk):
            n = self.merged(" " + chunk)
        else:
            word = chunk.rstrip(MARKS)  # marks after a word are a pre-token of their own
            n = self[word] + self.merged(chunk[len(word) :]) if word != chunk and _word(word) else self.count(" " + chunk)
        self[chunk] = n
        return n


class Counter:
    """Counts tokens of texts; ``whole`` are the proved strings.

    A pre-token never runs over a space unless that space has white space on both
    sides or ends the text after white space. So a text without such a place is cut at
    its spaces, and equal chunks are counted once; other texts are split as a whole.
    """

    def __init__(self, path: str, whole: list[str]):
        self.tok = _library(path)
        self.whole = frozenset(whole)
        self.split, self.astral, self.woven = regex.compile(PRETOKEN), re.compile(ASTRAL), re.compile(WOVEN)
        spec = json.loads(open(path, encoding="utf-8").read())
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.special = [t["content"] for t in added]
        #: the shortcut is proved for plain byte-level splitting; any other file goes through the library
        self.plain = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and len(self.special) <= 1
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self.model, self.letters = self.tok.model, byte_to_char()
        self.chunks = _Chunks(self._pretokens, self._pretoken)

    def _library_count(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def _pretoken(self, p: str) -> int:
        """A whole token counts one; any other pre-token is merged by the library's model, in its byte alphabet."""
        if p in self.whole:
            return 1
        if p.isascii() and p.isprintable():
            p = p.replace(" ", self.letters[32])
        else:
            p = "".join([self.letters[b] for b in p.encode()])
        return len(self.model.tokenize(p))

    def _pretokens(self, text: str) -> int:
        return sum([self._pretoken(p) for p in self.split.findall(text)])

    def _part(self, text: str) -> int:
        if self.woven.search(text):
            return self._pretokens(text)
        first, *chunks = text.split(" ")
        return self._pretokens(first) + sum(map(self.chunks.__getitem__, chunks))

    def count(self, text: str) -> int:
        if not self.plain or (not text.isascii() and self.astral.search(text)):
            return self._library_count(text)
        if self.special and self.special[0] in text:  # a special string inside a text is one token
            parts = text.split(self.special[0])
            n = len(parts) - 1 + sum(map(self._part, parts))
        else:
            n = self._part(text)
        if len(self.chunks) > CACHE_ENTRIES:
            self.chunks.clear()
        return n


def token_count(spark: SparkSession, path: str, text: Column) -> Column:
    """Token count of ``text`` (null: empty) as a long column; ``path`` must exist on every machine."""
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    whole = spark.sparkContext.broadcast(_proof(path, digest))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = Counter(path, whole.value)
        for s in batches:
            yield pd.Series([c.count(t) for t in s], dtype="int64")

    return count(body(text))


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Null and empty texts have no tokens. Special strings inside a text count as
    the library counts them by default; no tokens are added. Rows are independent:
    repeated rows and extra columns pass through unchanged.
    """
    return (
        docs.withColumn("n_bytes", F.octet_length(body(text)).cast("long"))
        .withColumn("n_tokens", token_count(docs.sparkSession, path, F.col(text)))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
