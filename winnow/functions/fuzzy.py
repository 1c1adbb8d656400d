"""Token-sort similarity in native expressions.

``100 * 2 * LCS / (m + n)`` of the texts with their white-space tokens sorted:
case sensitive. The longest common subsequence is a fold over the characters of one
side that carries one row of the table in the bits of longs. ``indel_ratio`` is native;
``indel_scores`` does the same for a batch of pairs at once and is meant for joins that
compare very many.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def token_sorted(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(text, r"\s+"), lambda t: t != "")), " ")


#: a row of the table fits the bits of a long for texts of at most so many characters
BIT_CHARS = 61


def _bit_lcs(short: Column, long: Column) -> Column:
    """LCS with a row of the table as the bits of one long: a cleared bit is a step of the row."""
    right, n = F.split(short, ""), F.length(short)
    full = F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1

    def mask(ch: Column) -> Column:
        at = F.transform(right, lambda c, j: F.when(c == ch, F.call_function("shiftleft", F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(at, F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(x))

    row = F.aggregate(F.transform(F.split(long, ""), mask), full, lambda v, m: (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full))
    return n - F.bit_count(row)


def _block_lcs(short: Column, long: Column) -> Column:
    """LCS of texts of any length: the row is an array of longs, and the carry of a sum passes from block to block."""
    right, width, full = F.split(short, ""), 60, (1 << 60) - 1
    count = F.ceil(F.length(short) / width).cast("int")

    def mask(ch: Column) -> Column:
        def block(chars: Column) -> Column:
            bits = F.transform(chars, lambda c, j: F.when(c == ch, F.call_function("shiftleft", F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long")))
            return F.aggregate(bits, F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(x))

        return F.transform(F.sequence(F.lit(0), count - 1), lambda k: block(F.slice(right, k * width + 1, F.lit(width))))

    letters = F.array_distinct(right)
    masks = F.map_from_arrays(letters, F.transform(letters, mask))
    # bits past the end of the short text stay set: no mask holds them
    start = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.lit(full).cast("long"))

    def row(v: Column, ch: Column) -> Column:
        m = F.try_element_at(masks, ch)

        def cell(acc: Column, k: Column) -> Column:
            old = F.get(v, k)
            hit = old.bitwiseAND(F.get(m, k))
            total = old + hit + acc["carry"]
            new = total.bitwiseOR(old - hit).bitwiseAND(F.lit(full).cast("long"))
            return F.struct(F.shiftright(total, width).cast("long").alias("carry"), F.concat(acc["out"], F.array(new)).alias("out"))

        init = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("out"))
        return F.when(m.isNull(), v).otherwise(F.aggregate(F.sequence(F.lit(0), count - 1), init, cell)["out"])

    end = F.aggregate(F.split(long, ""), start, row)
    return (count * width - F.aggregate(F.transform(end, F.bit_count), F.lit(0), lambda x, y: x + y)).cast("int")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts."""
    first = F.length(a) <= F.length(b)
    short, long = F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)
    none = (F.length(a) == 0) | (F.length(b) == 0)
    return F.when(none, F.lit(0)).when(F.length(short) <= BIT_CHARS, _bit_lcs(short, long)).otherwise(_block_lcs(short, long))


def indel_ratio(a: Column, b: Column) -> Column:
    """0 to 100; two empty texts are alike."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs_length(a, b) / total)


#: pairs that one step of the batch form works on
STEP = 4096


def _codes(texts: list[str], width: int, fill: int) -> np.ndarray:
    out = np.full((len(texts), width), fill, np.uint32)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _long_lcs(a: str, b: str) -> int:
    """The fold with one integer of any length as the row."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """LCS of each pair; pairs whose shorter text has at most 63 characters are folded side by side."""
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right, strict=True)]
    out = np.zeros(len(pairs), np.int64)
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][1]), len(pairs[i][0])))
    order = [i for i in order if pairs[i][0]]
    for at in range(0, len(order), STEP):
        part = order[at : at + STEP]
        long = [i for i in part if len(pairs[i][0]) > 63]
        for i in long:
            out[i] = _long_lcs(*pairs[i])
        part = [i for i in part if len(pairs[i][0]) <= 63]
        if not part:
            continue
        short, other = [pairs[i][0] for i in part], [pairs[i][1] for i in part]
        size = np.array([len(a) for a in short])
        # fills that never equal: a cell past either end is no match
        a, b = _codes(short, int(size.max()), 0xFFFFFFFE), _codes(other, max(map(len, other)), 0xFFFFFFFF)
        bit = np.uint64(1) << np.arange(a.shape[1], dtype=np.uint64)
        full = (np.uint64(1) << size.astype(np.uint64)) - np.uint64(1)
        row = full.copy()
        for j in range(b.shape[1]):
            hit = row & np.where(a == b[:, j : j + 1], bit, np.uint64(0)).sum(1, dtype=np.uint64)
            row = ((row + hit) | (row - hit)) & full
        out[part] = size - np.bitwise_count(row)
    return out


@F.pandas_udf(T.DoubleType())
def indel_scores(a: pd.Series, b: pd.Series) -> pd.Series:
    """``indel_ratio`` of a batch of pairs; null where either side is."""
    left, right = a.fillna("").tolist(), b.fillna("").tolist()
    total = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.float64)
    score = np.where(total == 0, 100.0, 200.0 * lcs_lengths(left, right) / np.maximum(total, 1))
    return pd.Series(score).mask((a.isna() | b.isna()).to_numpy())
