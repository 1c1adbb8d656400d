"""SimHash near-dedup with pigeonring candidate filtering.

A fingerprint's 64 bits form a ring of 16 segments of 4 bits. If two
fingerprints differ in at most 2 bits, some segment starts a chain in which any
first ``l`` segments differ in at most ``floor(2 l / 16)`` bits: seven segments
(28 bits) in nothing, fifteen (60 bits) in one bit, all sixteen in two. So each
distinct fingerprint is filed under its 16 rotations' first 28 bits; pairs of a
bucket pass the 60-bit budget before the full Hamming check.

Exact copies share a fingerprint and are filed once. A bucket with more than
``DENSE`` distinct fingerprints (a large group of near copies) is not compared
pair by pair: its fingerprints are filed again with each pair of bits that the
chain allows to differ masked out. Such groups have four members at most and
find every link of the bucket, so the work stays linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import body, connected_components, stored
from .shingles import majority, shingle_hashes

SEGMENTS, BITS, TAU = 16, 4, 2
EXACT_BITS = 28
#: buckets of at most so many distinct fingerprints are compared in place
DENSE = 1024
_LOW36 = (1 << 36) - 1


def fingerprint_column(width: int = 3):
    """Majority of the bits of each text's shingle hashes as a long; 0 without words."""

    @F.pandas_udf(T.LongType())
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([majority(h) for h in shingle_hashes(s, width)], np.uint64).view(np.int64))

    return column


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _near(x: np.ndarray) -> np.ndarray:
    """Chain budgets of rotated differences whose first 28 bits are 0, then the full check."""
    return (_popcount(x >> np.uint64(4)) <= 1) & (_popcount(x) <= TAU)


def _spanning(rot: np.ndarray) -> list[tuple[int, int]]:
    """Links of one bucket that connect what its near pairs connect."""
    left, edges = np.arange(1, len(rot)), []
    queue = [0]
    while len(left) or queue:
        if not queue:
            queue, left = [int(left[0])], left[1:]
        i = queue.pop()
        hit = _near(rot[left] ^ rot[i])
        found = left[hit].tolist()
        edges += [(i, j) for j in found]
        queue += found
        left = left[~hit]
        if not len(left):
            break
    return edges


def link_buckets(dense: int):
    """Streams rows (bucket, fp) sorted by bucket; yields links (src, dst) and the fingerprints of dense buckets."""

    def rotated(fp: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        s = ((bucket >> 28) * BITS).astype(np.uint64)
        u = fp.view(np.uint64)
        return np.where(s == 0, u, (u << s) | (u >> ((np.uint64(64) - s) & np.uint64(63))))

    def frame(src, dst, start) -> pd.DataFrame:
        return pd.DataFrame({"src": np.asarray(src, np.int64), "dst": np.asarray(dst, np.int64), "start": np.asarray(start, np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kb, kf = np.zeros(0, np.int64), np.zeros(0, np.int64)
        over = None  # the bucket that is known to be dense and still open

        def work(b: np.ndarray, f: np.ndarray) -> Iterator[pd.DataFrame]:
            starts = np.concatenate(([0], np.flatnonzero(b[1:] != b[:-1]) + 1))
            size = np.diff(np.concatenate((starts, [len(b)])))
            rot = rotated(f, b)
            for d in range(1, min(16, int(size.max()))):  # pairs of small buckets, by distance in the sorted rows
                i = np.flatnonzero((b[d:] == b[:-d]) & (np.repeat(size, size)[d:] <= 16))
                i = i[_near(rot[i] ^ rot[i + d])]
                if len(i):
                    yield frame(f[i], f[i + d], np.full(len(i), -1))
            for s, n in zip(starts[size > 16].tolist(), size[size > 16].tolist(), strict=True):
                part = f[s : s + n]
                if n > dense:
                    yield frame(part, part, np.full(n, b[s] >> 28))
                elif e := _spanning(rot[s : s + n]):
                    a, z = np.array(e).T
                    yield frame(part[a], part[z], np.full(len(e), -1))

        for batch in batches:
            b, f = np.concatenate((kb, batch.bucket.to_numpy())), np.concatenate((kf, batch.fp.to_numpy()))
            if not len(b):
                continue
            if over is not None:
                n = int(np.searchsorted(b != over, True)) if (b != over).any() else len(b)
                if n:
                    yield frame(f[:n], f[:n], np.full(n, over >> 28))
                b, f = b[n:], f[n:]
                if not len(b):
                    kb, kf = b, f
                    continue
                over = None
            last = len(b) - int((b == b[-1]).sum())
            if last:
                yield from work(b[:last], f[:last])
            kb, kf = b[last:], f[last:]
            if len(kb) > dense:  # dense for certain: nothing to hold back
                over = int(kb[0])
                yield frame(kf, kf, np.full(len(kf), over >> 28))
                kb, kf = kb[:0], kf[:0]
        if len(kb):
            yield from work(kb, kf)

    return run


def _rotate(fp, start):
    """Native left rotation of ``fp`` by 4 * start bits."""
    n = start * BITS
    right = F.call_function("shiftrightunsigned", fp, (F.lit(64) - n) % 64)
    return F.when(start == 0, fp).otherwise(F.call_function("shiftleft", fp, n).bitwiseOR(right))


def _masked_links(dense: DataFrame) -> DataFrame:
    """Links of dense buckets: fingerprints that agree under a mask differ in its two bits at most."""
    masks = [~((1 << i) | (1 << j)) for i in range(BITS) for j in range(36) if j >= BITS or j > i]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in (m & (2**64 - 1) for m in masks)]
    rows = dense.select(F.col("src").alias("fp"), "start", _rotate(F.col("src"), F.col("start")).alias("rot")).select(
        "fp", "start", F.explode(F.transform(F.array(*[F.lit(m) for m in signed]), lambda m: F.struct(m.alias("m"), F.col("rot").bitwiseAND(m).alias("k")))).alias("x")
    )
    groups = rows.groupBy("start", "x.m", "x.k").agg(F.min("fp").alias("src"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return groups.select("src", F.explode("all").alias("dst")).where("src <> dst")


def fingerprint_links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links (src, dst) among distinct fingerprints ``fps(fp)`` that connect all within 2 bits."""
    arcs = F.transform(
        F.sequence(F.lit(0), F.lit(SEGMENTS - 1)),
        lambda s: F.shiftleft(s.cast("long"), EXACT_BITS).bitwiseOR(F.shiftrightunsigned(_rotate(F.col("fp"), s), 64 - EXACT_BITS)),
    )
    filed = fps.select("fp", F.explode(arcs).alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "fp")
    found = stored(filed.mapInPandas(link_buckets(dense), "src long, dst long, start int"))
    return found.where("start < 0").select("src", "dst").unionByName(_masked_links(found.where("start >= 0")))


def near_duplicates(docs: DataFrame, dense: int = DENSE, width: int = 3, similarity: float | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row.

    Null and empty texts have fingerprint zero and link like any other.
    component_id is the smallest doc_id reachable over links of at most 2
    differing bits; rows of equal doc_id share what any of them reaches through
    its own text only. A null doc_id never names a component unless all of its
    members are null. Texts are hashed whole, however long; repeated rows link like copies; an
    empty table gives no rows. Other columns are not read.

    With ``similarity`` (0.8) texts link if their shingle sets have that Jaccard
    similarity: the fingerprints' links are checked against the sets, and an exact search
    adds those that fingerprints cannot find (:mod:`near_copies`).
    """
    if similarity is not None:
        from . import near_copies

        if similarity * near_copies.DEN != near_copies.NUM:
            raise ValueError("the similarity search is built for 0.8")
        return near_copies.near_copies(docs, width, dense)
    prints = stored(docs.select("doc_id", fingerprint_column(width)(body()).alias("fp")))
    each = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(fingerprint_links(each.select("fp"), dense))
    named = each.join(roots, each.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    linked = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(named.join(linked, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
