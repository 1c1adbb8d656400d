"""The nearest names by token-sort ratio, over blocks that Spark pairs, without scoring every pair.

At a ratio of 70 nearly a third of the letters may differ, so segments and q-grams that two
names must share are one or two letters long and select nothing. What bounds the ratio
well is the bag of letters: the common subsequence is no longer than the letters that both
names hold, repeats counted. A name's bag is 256 bits, one for each letter and its number
among equal ones; letters that share a bit are counted as a loss, so the bound stays
an upper one. A block of names meets a block of the registry as a matrix of such bounds.
The few pairs of the highest bound are scored first; only those whose bound reaches the k-th best
score then are scored too. Nothing that belongs to the k best is left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import _long_lcs, token_sorted
from ..store import stored

#: names of one block of either side
BLOCK = 8_192
#: names whose bounds are held at once, and letters that a row of the table holds
ROWS, ROW_LETTERS = 128, 63
WORDS = 4
#: from this ratio on, bounds alone leave few pairs; the ratio that only equal texts have
HIGH, EQUAL = 60.0, 100.0


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bits, loss): the bag of each text as WORDS words of 64 bits, and how many letters share a bit with another."""
    bits, loss = np.zeros((len(texts), WORDS), np.uint64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        seen: dict[str, int] = {}
        held = 0
        for c in t:
            n = seen[c] = seen.get(c, 0) + 1
            held |= 1 << ((ord(c) * 37 + n * 101) & 255)
        bits[i] = [(held >> 64 * w) & 0xFFFFFFFFFFFFFFFF for w in range(WORDS)]
        loss[i] = len(t) - held.bit_count()
    return bits, loss


class Block:
    """Texts of one side with what bounds and scores need."""

    def only(self, rows: np.ndarray) -> Block:
        """The block of some of its rows."""
        out = Block.__new__(Block)
        out.texts = [self.texts[i] for i in rows.tolist()]
        out.length, out.bits, out.loss, out.codes = self.length[rows], self.bits[rows], self.loss[rows], self.codes[rows]
        return out

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.length = np.array([len(t) for t in texts], np.int64)
        self.bits, self.loss = bags(texts)
        self.codes = np.zeros((len(texts), int(self.length.max(initial=0))), np.uint32)
        for i, t in enumerate(texts):
            self.codes[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)


def _common(a: Block, rows: slice, b: Block) -> np.ndarray:
    """Upper bounds of the common subsequence of the rows of ``a`` with all of ``b``, cut at 255, which stands for no bound."""
    common = np.zeros((a.length[rows].size, b.length.size), np.uint8)
    for w in range(WORDS):
        common += np.bitwise_count(a.bits[rows, w][:, None] & b.bits[None, :, w])
    loss = np.minimum(a.loss[rows], 255).astype(np.uint8)[:, None], np.minimum(b.loss, 255).astype(np.uint8)[None, :]
    if max(loss[0].max(initial=0), loss[1].max(initial=0)) > 0:
        extra = np.minimum(*loss)
        common = np.where(common > 255 - extra, np.uint8(255), common + extra)
    # only texts of 255 letters can share so many bits
    common[np.ix_(a.length[rows] >= 255, b.length >= 255)] = 255
    return common


def _bounds(common: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Upper bounds of the ratio."""
    most = np.minimum(m[:, None], n[None, :])
    return _ratio(np.where(common == 255, most, np.minimum(common, most)), m[:, None] + n[None, :])


def _reaching(common: np.ndarray, m: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose bound may reach ``least``, by a table of what each pair of lengths needs."""
    lengths, at = np.unique(n, return_inverse=True)
    total = m[:, None] + lengths[None, :]
    need = np.ceil(least * total / 200.0 - 1e-9)
    need = np.where(need > np.minimum(m[:, None], lengths[None, :]), np.where(total > 0, 256, 0), np.minimum(need, 255)).astype(np.int16)
    none = need > 255  # not even by length
    return np.nonzero((common >= np.minimum(need, 255).astype(np.uint8)[:, at]) & ~none[:, at])


def _ratio(lcs: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total == 0, 100.0, 200.0 * lcs / np.maximum(total, 1))


def _scores(a: Block, i: np.ndarray, b: Block, j: np.ndarray) -> np.ndarray:
    """Ratios of the pairs (i, j): one row of the table for each pair, folded over the letters of ``b`` side by side."""
    m, n = a.length[i], b.length[j]
    lcs = np.zeros(len(i), np.int64)
    fits = m <= ROW_LETTERS
    for p in np.flatnonzero(~fits).tolist():
        x, y = a.texts[i[p]], b.texts[j[p]]
        lcs[p] = _long_lcs(x, y) if len(x) <= len(y) else _long_lcs(y, x)
    order = np.flatnonzero(fits & (m > 0) & (n > 0))
    order = order[np.argsort(n[order], kind="stable")]
    # for each text of a that is met: the places of each letter as the bits of a word
    met, slot = np.unique(i[order], return_inverse=True)
    letters = np.unique(a.codes[met])
    table = np.zeros((len(met), len(letters) + 1), np.uint64)
    for s, x in enumerate(met.tolist()):
        at = np.searchsorted(letters, a.codes[x, : a.length[x]])
        np.bitwise_or.at(table[s], at, np.uint64(1) << np.arange(len(at), dtype=np.uint64))
    for start in range(0, len(order), 65_536):
        part = order[start : start + 65_536]
        s, width = slot[start : start + 65_536], int(n[part].max())
        full = (np.uint64(1) << m[part].astype(np.uint64)) - np.uint64(1)
        row = full.copy()
        codes = b.codes[j[part], :width]
        at = np.searchsorted(letters, codes)
        at = np.where((at < len(letters)) & (letters[np.minimum(at, len(letters) - 1)] == codes), at, len(letters))
        at = np.where(np.arange(width)[None, :] < n[part][:, None], at, len(letters))
        for t in range(width):
            hit = row & table[s, at[:, t]]
            row = ((row + hit) | (row - hit)) & full
        lcs[part] = m[part] - np.bitwise_count(row)
    return _ratio(lcs, m + n)


def _nearest(k: int, least: float):
    def search(names: pd.DataFrame, registry: pd.DataFrame) -> pd.DataFrame:
        columns = ["raw", "canonical", "score"]
        if not len(names) or not len(registry):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})
        registry = registry.sort_values("canonical", ignore_index=True)  # places then break ties
        a, b = Block(names.s.tolist()), Block(registry.sr.tolist())
        raw, canonical, out = names.raw.to_numpy(object), registry.canonical.to_numpy(object), []
        for at in range(0, len(names), ROWS):
            part = slice(at, at + ROWS)
            common, m = _common(a, part, b), a.length[part]
            rows, width = common.shape
            if least >= HIGH:  # few pairs reach it
                i, j = _reaching(common, m, b.length, least)
                score = _scores(a, i + at, b, j)
            else:
                bound = _bounds(common, m, b.length)
                first = np.argpartition(-bound, k - 1, axis=1)[:, :k] if width > k else np.broadcast_to(np.arange(width), bound.shape)
                i, j = np.repeat(np.arange(rows), first.shape[1]), first.ravel()
                score = _scores(a, i + at, b, j)
                reached = score.reshape(rows, -1).min(1) if width >= k else np.full(rows, least)
                bound[i, j] = -1  # scored already
                more_i, more_j = np.nonzero(bound >= np.maximum(reached, least)[:, None])
                i, j = np.concatenate((i, more_i)), np.concatenate((j, more_j))
                score = np.concatenate((score, _scores(a, more_i + at, b, more_j)))
            use = score >= least
            i, j, score = i[use], j[use], score[use]
            order = np.lexsort((j, -score, i))
            i, j, score = i[order], j[order], score[order]
            new = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1]))) if len(i) else np.zeros(0, np.int64)
            place = np.arange(len(i)) - np.repeat(new, np.diff(np.append(new, len(i))))
            top = place < k
            out.append((i[top] + at, j[top], score[top]))
        i, j, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pd.DataFrame({"raw": pd.Series(raw[i], dtype=object), "canonical": pd.Series(canonical[j], dtype=object), "score": score})

    return search


def nearest_names(names: DataFrame, registry: DataFrame, k: int = 3, least: float = 0.0) -> DataFrame:
    """(raw, canonical, score, rank): the ``k`` registry names nearest to each distinct raw name, of scores from ``least``, ties by name.

    Both sides are stored, counted and dealt into blocks of about ``BLOCK`` by hash; each pair of
    blocks is one group, which gives at most k rows a name. From a ratio of EQUAL, which only equal
    texts have, a join finds them. Null names are left out.
    """
    raw = names.select("raw").where(F.col("raw").isNotNull()).distinct().withColumn("s", token_sorted(F.trim("raw")))
    reg = registry.select("canonical").where(F.col("canonical").isNotNull()).distinct().withColumn("sr", token_sorted(F.col("canonical")))
    if least >= EQUAL:
        first = F.row_number().over(Window.partitionBy("sr").orderBy("canonical"))
        same = raw.join(reg.withColumn("rank", first).where(F.col("rank") <= k), F.col("s") == F.col("sr"))
        return same.select("raw", "canonical", F.lit(EQUAL).alias("score"), "rank").where(F.col("score") >= least)
    raw, reg = stored(raw), stored(reg)
    n, m = (max(1, -(-d.count() // BLOCK)) for d in (raw, reg))
    deal = lambda c, blocks: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = raw.select(deal("raw", n).alias("a"), every(m).alias("b"), "raw", "s").groupBy("a", "b")
    right = reg.select(every(n).alias("a"), deal("canonical", m).alias("b"), "canonical", "sr").groupBy("a", "b")
    found = left.cogroup(right).applyInPandas(_nearest(k, least), "raw string, canonical string, score double")
    rank = F.row_number().over(Window.partitionBy("raw").orderBy(F.desc("score"), "canonical"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _dealt(left: DataFrame, right: DataFrame, counts: tuple[int, int]):
    """Both sides (id, s) in blocks of about BLOCK, each pair of blocks a group."""
    n, m = (max(1, -(-c // BLOCK)) for c in counts)
    deal = lambda blocks: F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    one = left.select(deal(n).alias("x"), every(m).alias("y"), "id", "s").groupBy("x", "y")
    # columns of its own, as both sides may be one table
    return one.cogroup(right.select(every(n).alias("x"), deal(m).alias("y"), F.col("id").alias("other"), F.col("s").alias("t")).groupBy("x", "y"))


def _alike(ratio: float, rising: bool):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "score": np.zeros(0)})
        a, b = Block(left.s.tolist()), Block(right.t.tolist())
        one, two, out = left.id.to_numpy(), right.other.to_numpy(), []
        for at in range(0, len(left), ROWS):
            part = slice(at, at + ROWS)
            i, j = _reaching(_common(a, part, b), a.length[part], b.length, ratio)
            i = i + at
            if rising:
                i, j = i[one[i] < two[j]], j[one[i] < two[j]]
            score = _scores(a, i, b, j)
            out.append((one[i[score >= ratio]], two[j[score >= ratio]], score[score >= ratio]))
        found = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("a", "b", "score"), found, strict=True)))

    return search


def alike(left: DataFrame, right: DataFrame, counts: tuple[int, int], ratio: float, rising: bool = False) -> DataFrame:
    """(a, b, score): pairs of ``left(id, s)`` and ``right(id, s)``, texts with sorted tokens, of a ratio from ``ratio``; if ``rising`` only a < b."""
    return _dealt(left, right, counts).applyInPandas(_alike(ratio, rising), "a long, b long, score double")


def first_come(rows: DataFrame, ratio: float) -> DataFrame:
    """(id) of those of ``rows(id, s)``, one block in order of id, that are alike to no earlier one which stays."""

    def work(batches):
        parts = list(batches)  # one block
        if not parts:
            return
        rows = pd.concat(parts).sort_values("id", ignore_index=True)
        texts, kept = rows.s.tolist(), []
        whole = Block(texts)
        for at in range(0, len(texts), ROWS):
            part, m = slice(at, at + ROWS), whole.length[at : at + ROWS]
            gone = np.zeros(len(m), bool)
            if kept:
                held = whole.only(np.array(kept))
                i, j = _reaching(_common(whole, part, held), m, held.length, ratio)
                gone[i[_scores(whole, i + at, held, j) >= ratio]] = True
            here = whole.only(at + np.flatnonzero(~gone))
            i, j = _reaching(_common(here, slice(None), here), here.length, here.length, ratio)
            i, j = i[i < j], j[i < j]
            near = _scores(here, i, here, j) >= ratio
            out = np.zeros(len(here.length), bool)
            for x, y in sorted(zip(i[near].tolist(), j[near].tolist(), strict=True), key=lambda p: (p[1], p[0])):
                out[y] |= not out[x]
            kept += (at + np.flatnonzero(~gone)[~out]).tolist()
        yield pd.DataFrame({"id": rows.id.to_numpy()[kept]})

    return rows.select("id", "s").repartition(1).mapInPandas(work, "id long")
