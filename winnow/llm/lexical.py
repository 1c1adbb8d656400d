"""Ranked lexical search as a blocked sparse matrix product.

Scores of items (rows) and documents (columns) are the product of the item-term matrix of
multiplicities and the term-document matrix of impacts, both sparse and of 64-bit
integers. A task takes the documents of an Arrow batch as a block of columns and forms
the product row by row (Gustavson): the impact rows of an item's terms are scaled and
merged in one dense accumulator as wide as the block. Each block is reduced to the k
best of each item at once, so a task holds k rows an item, whatever it reads.

Texts are split once, into postings of the items' terms; document frequencies are counted
from these, and the product reads them again. Items are dealt into blocks by the number of
their terms, so that the vocabulary that travels to the tasks is bounded.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import UPPER, stored

#: terms of the items of one block, about; each block reads the texts once
BLOCK_TERMS = 200_000
#: documents that meet the items at once
BLOCK_DOCS = 8192
#: fixed values of the score
SCALE, TF_UNIT, LENGTH_SHARE, SATURATION = 1000, 1_000_000_000, 75, 8

# The ASCII bytes that separate terms are all but 0-9, A-Z and a-z.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_SPLIT = bytes.maketrans(_SEPARATORS + UPPER.encode(), b" " * len(_SEPARATORS) + UPPER.lower().encode())


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of non-separators of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_SPLIT).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, times, size): each distinct row of ``items`` with its terms, numbered."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [Counter(terms_of(t.as_py() or b"")) for t in b.column("text")]
            held = [pa.array([list(c) for c in found], pa.list_(pa.binary())), pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), *held], ["item_id", "terms", "times"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    rows = rows.mapInArrow(split, f"item_id {kind}, terms array<binary>, times array<long>")
    return stored(rows.withColumns({"item": F.monotonically_increasing_id(), "size": F.size("terms")}).where("size > 0"))


def _postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: places in ``vocabulary`` and how often they occur."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                if found := terms_of(text.as_py() or b""):
                    held = Counter(map(place, found))
                    held.pop(None, None)
                    rows.append((doc_id, len(found), list(held), list(held.values())))
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            kinds = (b.schema.field("doc_id").type, pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(split, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


def _merged(rows: np.ndarray, times: np.ndarray, start: np.ndarray, columns: np.ndarray, impact: np.ndarray, width: int) -> np.ndarray:
    """One row of the product: the impact rows ``rows``, each scaled, merged in a dense accumulator."""
    out = np.zeros(width, np.int64)
    for t, n in zip(rows.tolist(), times.tolist(), strict=True):
        part = slice(start[t], start[t + 1])
        out[columns[part]] += n * impact[part]  # a document occurs once in a term's row
    return out


def _product(postings: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each item among those of a task."""
    shared = postings.sparkSession.sparkContext.broadcast((items, weight))
    kind = postings.schema["doc_id"].dataType.simpleString()

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, w = shared.value
        best = [[np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)] for _ in rows]  # ids, without an id, scores
        id_type = None
        for whole in batches:
            for at in range(0, len(whole), BLOCK_DOCS):
                b = whole.slice(at, BLOCK_DOCS)
                id_type = b.schema.field("doc_id").type
                ids = np.array([v if v is not None else 0 for v in b.column("doc_id").to_pylist()], np.int64)
                none = np.asarray(b.column("doc_id").is_null())
                m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms for n in b.column("n").to_pylist()], np.int64)
                sizes = np.asarray(pa.compute.list_value_length(b.column("terms")), np.int64)
                terms, tf = np.asarray(b.column("terms").flatten(), np.int64), np.asarray(b.column("tfs").flatten(), np.int64)
                columns = np.repeat(np.arange(len(b)), sizes)
                order = np.argsort(terms, kind="stable")
                terms, tf, columns = terms[order], tf[order], columns[order]
                impact = w[terms] * ((TF_UNIT * tf) // (SCALE * tf + SATURATION * m[columns]))
                start = np.searchsorted(terms, np.arange(len(w) + 1))
                for i, (_, item_terms, times) in enumerate(rows):
                    score = _merged(item_terms, times, start, columns, impact, len(b))
                    least = max(1, best[i][2][-1]) if len(best[i][2]) == k else 1
                    if np.count_nonzero(score >= least) > k:
                        least = max(least, np.partition(score, -k)[-k])
                    new = np.flatnonzero(score >= least)
                    if len(new):
                        held = [np.concatenate(p) for p in zip(best[i], (ids[new], none[new], score[new]), strict=True)]
                        top = np.lexsort((held[0], held[1], -held[2]))[:k]
                        best[i] = [p[top] for p in held]
        if id_type is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([r[0] for r in rows], [len(p[2]) for p in best]), pa.int64()),
                    pa.array(np.concatenate([p[0] for p in best]), pa.int64(), mask=np.concatenate([p[1] for p in best])).cast(id_type),
                    pa.array(np.concatenate([p[2] for p in best]), pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return postings.mapInArrow(product, f"item long, doc_id {kind}, score long")


def _ranked_block(docs: DataFrame, rows: list[Row], k: int) -> DataFrame:
    vocabulary = sorted({bytes(t) for r in rows for t in r.terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    postings = stored(_postings(docs, vocabulary))
    size = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weight[r.term] = math.floor(SCALE * math.log((2 * size.docs + 2) / (2 * r["count"] + 1)))
    items = [(r.item, np.array([place[bytes(t)] for t in r.terms]), np.array(r.times, np.int64)) for r in rows]
    return stored(_product(postings, items, weight, size.docs, size.terms or 1, k))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``.

    Scores are whole numbers: a term of an item, as often as it occurs there, adds
    ``w * ((10^9 tf) div (1000 tf + 8 m))`` with w = floor(1000 ln((2N + 2) / (2 df + 1))) and
    m = 25 + (75 n N) div L. Only scores above 0 are given; equal ones go by doc_id, nulls last.
    Null, empty and term-less texts count nowhere; an item without terms, and any item if there are no documents, has
    no rows. Every row of ``docs`` is a document, repeated rows too. Equal rows of ``items``
    are one item; rows that share an id but not the text are ranked each on its own, as are
    rows without an id. ``doc_id`` is an integer. Other columns are not read.
    """
    found = _item_terms(items)
    terms = found.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-terms // block_terms))
    parts = None
    for at in range(blocks):
        rows = found.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == at).select("item", "terms", "times").collect()
        if rows:
            part = _ranked_block(docs, sorted(rows, key=lambda r: r.item), k)
            parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        kinds = (items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString())
        return docs.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(found.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
