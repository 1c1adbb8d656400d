"""Exact line dedup with per-document keep bitmaps.

Hashes of the lines' keys are dealt by range over (hash, document, position),
each range is sorted and streamed once, and the first document of a hash (the
largest doc_id) keeps its lines. The result is one compressed bitmap for each
document that loses lines; text never takes part in the sort.

A hash may cross the border of two ranges (a line held by a third of all
documents fills several). Rows of such border runs are passed on together with
a small summary of the run (its largest document, up to ``min_docs`` documents);
there are at most two summaries a range, so they are joined by broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, ascii_lower, body, fingerprint_of, set_aside, stored

LOWEST = -(2**63)
STREAM = "h1 long, h2 long, nd long, th long, pos int, n_lines int, kind int, docs array<long>"


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, nd, th, pos, n_lines) for each line whose key is long enough."""
    lines = F.split(body(), "\n")
    rows = docs.select(
        F.bitwise_not(F.coalesce("doc_id", F.lit(LOWEST))).alias("nd"), fingerprint_of().alias("th"), lines.alias("lines")
    ).select("nd", "th", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    bare = F.trim(F.col("line"), F.lit(ASCII_SPACE))
    rows = rows.withColumn("bare", bare).where(F.char_length("bare") >= min_chars).withColumn("key", ascii_lower(F.col("bare")))
    return rows.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "nd", "th", "pos", "n_lines"
    )


def _stream(min_docs: int):
    """Streams sorted rows. kind 0: this line is dropped; 1: a row of a border run; 2: summary of a border run."""
    cols = ["h1", "h2", "nd", "th", "pos", "n_lines"]

    def emit(rows: pd.DataFrame, kind: int) -> pd.DataFrame:
        return rows[cols].assign(kind=np.int32(kind), docs=None)

    def summary(h: tuple, docs: list) -> pd.DataFrame:
        return pd.DataFrame(
            {"h1": [h[0]], "h2": [h[1]], "nd": [0], "th": [0], "pos": [0], "n_lines": [0], "kind": [2], "docs": [docs]}
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, first_docs = None, []  # the range's first hash and its first documents
        open_h, open_docs, held = None, [], []  # the run that a later batch may carry on; its rows while undecided

        def leading(docs: list, nd: np.ndarray) -> list:
            # nd is sorted, so new documents follow the known ones
            new = np.unique(nd)[: min_docs + 1]
            return (docs + [int(x) for x in new if not docs or x > docs[-1]])[:min_docs]

        for b in batches:
            if not len(b):
                continue
            h1, h2 = b.h1.to_numpy(), b.h2.to_numpy()
            cut = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
            starts = np.concatenate(([0], cut))
            ends = np.concatenate((cut, [len(b)]))
            if first is None:
                first = (h1[0], h2[0])
            lo = 0
            # the batch's first run may belong to the range's first run or to the open one
            if (h1[0], h2[0]) == first:
                first_docs = leading(first_docs, b.nd.to_numpy()[: ends[0]])
                yield emit(b.iloc[: ends[0]], 1)
                lo = 1
            elif (h1[0], h2[0]) == open_h:
                part = b.iloc[: ends[0]]
                open_docs = leading(open_docs, part.nd.to_numpy())
                held.append(part)
                if len(open_docs) >= min_docs:
                    rows = pd.concat(held)
                    yield emit(rows[rows.nd != open_docs[0]], 0)
                    held = []
                lo = 1
            if lo == len(starts):
                continue
            open_h, open_docs, held = None, [], []  # an undecided run that ended has too few documents
            if lo < len(starts) - 1:  # runs that both begin and end in this batch
                part = b.iloc[starts[lo] : starts[-1]]
                nd = part.nd.to_numpy()
                s = starts[lo:-1] - starts[lo]
                newrun = np.zeros(len(part), bool)
                newrun[s] = True
                newdoc = newrun.copy()
                newdoc[1:] |= nd[1:] != nd[:-1]
                rank = np.cumsum(newdoc)
                size = np.diff(np.concatenate((s, [len(part)])))
                rank = rank - np.repeat(rank[s], size)
                many = np.repeat(np.maximum.reduceat(rank, s) + 1 >= min_docs, size)
                if (drop := many & (rank > 0)).any():
                    yield emit(part[drop], 0)
            part = b.iloc[starts[-1] :]
            open_h = (h1[-1], h2[-1])
            open_docs = leading([], part.nd.to_numpy())
            held = [part]
            if len(open_docs) >= min_docs:
                yield emit(part[part.nd != open_docs[0]], 0)
                held = []
        if open_h is not None:
            yield summary(open_h, open_docs)
            if held:
                yield emit(pd.concat(held), 1)
        if first is not None:
            yield summary(first, first_docs)

    return run


@F.pandas_udf(T.BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(n: int, gone: np.ndarray) -> bytes:
        keep = np.ones(n, np.uint8)
        keep[np.asarray(gone, dtype=np.int64)] = 0
        return zlib.compress(np.packbits(keep).tobytes(), 6)

    return pd.Series([one(n, g) for n, g in zip(n_lines, dropped, strict=True)], dtype=object)


def line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, th, n_lines, n_dropped, keep_bitmap) for documents that lose lines.

    A line's key is the line stripped of ASCII white space with A-Z
    lower-cased. Keys of at least ``min_chars`` code points held by at least
    ``min_docs`` documents stay only in the largest doc_id. Documents without a
    row keep every line. ``th`` is the text's hash: rows that share a doc_id are
    one document for counting but each text has its own bitmap. A null doc_id
    counts as one document below all others. Null text is one empty line.
    """
    keys = stored(line_keys(docs, min_chars))
    order = ["h1", "h2", "nd", "th", "pos"]
    streamed = stored(keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_stream(min_docs), STREAM))
    runs = (
        streamed.where("kind = 2")
        .groupBy("h1", "h2")
        .agg(F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs"))
        .where(F.size("docs") >= min_docs)
        .select("h1", "h2", F.array_min("docs").alias("keeper"))
    )
    border = streamed.where("kind = 1").join(F.broadcast(runs), ["h1", "h2"]).where("nd <> keeper")
    drops = streamed.where("kind = 0").select("nd", "th", "pos", "n_lines").unionByName(border.select("nd", "th", "pos", "n_lines"))
    return (
        drops.groupBy("nd", "th")
        .agg(F.first("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("dropped"))
        .select(
            F.nullif(F.bitwise_not("nd"), F.lit(LOWEST)).alias("doc_id"),
            "th",
            "n_lines",
            F.size("dropped").cast("long").alias("n_dropped"),
            _bitmap("n_lines", "dropped").alias("keep_bitmap"),
        )
    )


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(t: str, m: bytes | None) -> str:
        if m is None:
            return t
        lines = t.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(m), np.uint8), count=len(lines))
        return "\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k])

    return pd.Series([one(t, m) for t, m in zip(text, bitmap, strict=True)], dtype=object)


def with_kept_text(docs: DataFrame, bitmaps: DataFrame, out: str = "kept_text") -> DataFrame:
    """``docs`` with the kept text (null text reads as empty) and n_dropped."""
    docs, restored = set_aside(docs, ("doc_id", "text"))
    right = bitmaps.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), F.col("n_dropped").alias("_gone"), "keep_bitmap")
    joined = docs.join(right, F.col("doc_id").eqNullSafe(F.col("_doc")) & (fingerprint_of() == F.col("_th")), "left")
    joined = joined.withColumn(out, _kept(body(), F.col("keep_bitmap"))).withColumn("n_dropped", F.coalesce("_gone", F.lit(0)))
    return restored(joined, [out, "n_dropped"])
