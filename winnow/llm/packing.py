"""Best-fit packing into bins of several permitted lengths.

Documents are cut into pieces of at most the largest length. Items are dealt by
hash into packing groups of a fixed expected size, so each group is one bounded
task however large the corpus is. Within a group, items go by falling length into
the open bin with the least room that holds them. If none does, every permitted
length is filled on trial with the items still to come, and the one of least cost for
each token it would hold is opened. At the end each bin is cut down to the smallest
permitted length that holds its contents.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .token_counts import token_count

#: permitted lengths and the cost of a bin of each: its tokens, a fixed start-up and a share that grows with the square
LENGTHS = (512, 1024, 2048, 4096)


def bin_cost(length: int) -> float:
    return 64 + length + length * length / 65_536


def fill(room: int, sizes: list[int], count: int) -> int:
    """Tokens that the ``count`` first of the rising ``sizes`` bring into ``room``, the longest that fits first."""
    used = 0
    i = bisect_right(sizes, room, 0, count) - 1
    while i >= 0 and sizes[i]:
        used += sizes[i]
        i = bisect_right(sizes, room - used, 0, i) - 1
    return used


def least_cost(n: int, sizes: list[int], count: int, lengths: list[int]) -> int:
    """The length to open for an item of ``n`` tokens when the ``count`` first of the rising ``sizes`` are still to come.

    Every permitted length is filled with them on trial and cut down to what it then holds;
    the least cost for each token in it wins, the shorter length among equals.
    """

    def cost(length: int) -> float:
        used = n + fill(length - n, sizes, count)
        return bin_cost(next(x for x in lengths if x >= used)) / max(1, used)

    return min((x for x in lengths if x >= n), key=lambda x: (cost(x), x))


def pack_group(sizes: list[int], lengths=LENGTHS) -> tuple[list[tuple[int, int]], list[int]]:
    """((bin, offset) of each item, final length of each bin) for items of at most the largest length.

    Items of size 0 take no room and go to the first bin.
    """
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    rising = sorted(sizes)
    place: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    room: list[int] = []  # distinct rooms of open bins, sorted
    bins: dict[int, list[int]] = {}  # room -> heap of its bins
    used: list[int] = []
    for k, i in enumerate(order, 1):
        n = sizes[i]
        at = bisect_left(room, n)
        if at < len(room):
            r = room[at]
            b = heapq.heappop(bins[r])
            if not bins[r]:
                del bins[r], room[at]
        else:
            r = least_cost(n, rising, len(sizes) - k, lengths)
            b = len(used)
            used.append(0)
        place[i] = (b, used[b])
        used[b] += n
        if r - n not in bins:
            insort(room, r - n)
            bins[r - n] = []
        heapq.heappush(bins[r - n], b)
    return place, [next(x for x in lengths if x >= u) for u in used]


def pieces(items: DataFrame, longest: int, size: str = "n_tokens") -> DataFrame:
    """One row for each piece of at most ``longest`` tokens: adds piece, start and length. Size 0 is one empty piece."""
    last = F.greatest(F.lit(0).cast("long"), F.floor((F.col(size) - 1) / longest).cast("long"))
    return (
        items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("start", F.col("piece") * longest)
        .withColumn("length", F.least(F.lit(longest).cast("long"), F.col(size) - F.col("start")))
    )


#: copies of one row that one row of the first expansion stands for
COPIES_BLOCK = 65_536


def numbered_copies(items: DataFrame, *columns: str) -> DataFrame:
    """``items(columns)`` with ``copy``: 0, 1, .. among equal rows.

    Equal rows are counted, which needs no row of a group in one place, and given out again by blocks.
    """
    counted = items.groupBy(*columns).agg(F.count("*").alias("_n"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_BLOCK))))
    last = F.least(F.lit(COPIES_BLOCK), F.col("_n") - F.col("_block") * COPIES_BLOCK) - 1
    spread = blocks.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    return spread.select(*columns, (F.col("_block") * COPIES_BLOCK + F.col("_at")).alias("copy"))


def best_fit(items: DataFrame, lengths=LENGTHS, group_rows: int = 8192, size: str = "n_tokens") -> DataFrame:
    """``items(doc_id, n_tokens)`` packed: doc_id, piece, start, length, bin, offset, bin_length.

    Every token of every row is placed once; ``bin`` is unique over all groups. A
    null size counts as 0. Repeated rows are packed each; they are numbered, so that equal rows,
    rows without an id among them, are dealt over the groups like any others. A null doc_id is packed
    as any other. A very long text is cut into pieces of the largest length; an empty table gives no
    rows. Other columns are not read.
    """
    longest = max(lengths)
    each = numbered_copies(items.select("doc_id", F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(size)), "doc_id", size)
    rows = stored(pieces(each, longest, size))
    groups = max(1, -(-rows.count() // group_rows))
    key = F.pmod(F.xxhash64("doc_id", "piece", size, "copy"), F.lit(groups))
    dealt = rows.withColumn("g", key)
    out = "doc_id long, piece long, start long, length long, bin string, offset long, bin_length long"

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "copy"], kind="stable", ignore_index=True)
        place, final = pack_group(pdf.length.astype(int).tolist(), lengths)
        b, offset = zip(*place, strict=True)
        g = int(pdf.g.iloc[0])
        return pd.DataFrame(
            {
                "doc_id": pdf.doc_id.astype("Int64"), "piece": pdf.piece, "start": pdf.start, "length": pdf.length,
                "bin": [f"{g}-{x}" for x in b], "offset": offset, "bin_length": [final[x] for x in b],
            }
        )

    return dealt.select("doc_id", "piece", "copy", "start", "length", "g").groupBy("g").applyInPandas(work, out)


def token_sizes(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens): tokens of the text in the vocabulary at ``path`` and one separator as the length to pack."""
    return docs.select("doc_id", (token_count(docs.sparkSession, path, F.col("text")) + 1).alias("n_tokens"))
