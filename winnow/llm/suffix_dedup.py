"""Removal of repeated byte strings with a difference-cover suffix array.

A byte is removed if a string of ``length`` bytes that covers it also starts
somewhere else in the corpus.

One suffix array over the whole corpus would move every suffix through several
sorts. So the suffixes are first dealt into buckets that any two suffixes with
an equal ``length``-byte prefix share, and each bucket is sorted on its own by the
difference-cover algorithm (sort the sampled triples, recurse on their names,
merge the remaining suffixes, compare adjacent prefixes):

1. The window of ``length`` bytes at a start has an anchor, the k-mer in it with
   the smallest hash, which depends on the window's bytes only. Neighbouring
   starts with one anchor form a run, cut at fixed distances from the anchor. All
   windows of a run share 300 bytes; their hash is the bucket's key.
2. Runs whose key no other run has cannot repeat and are left out.
3. The bytes of the other runs are fetched, equal runs are merged, and the
   suffixes of the distinct runs in a bucket are sorted.

Hashes only deal out the work: what is removed is decided by comparing bytes, whatever
the size. A key that more than ``HOT_RUNS`` runs have, a passage of very many texts, would be
one task's bucket. The starts of its runs are dealt by two 64-bit hashes of their strings
instead, and each is compared byte by byte with one start that stands for its hashes; what
differs is dealt again without that one.
Texts with an exact copy are removed whole without any of this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import body, set_aside, stored

LENGTH, KMER = 400, 100
#: starts of one run lie within so many bytes; with LENGTH they leave 300 shared bytes
RUN = 101
#: bytes of contexts sorted at once; a larger bucket is split by longer shared strings first
SORT_BYTES = 500_000
#: bytes of text hashed at once; longer texts are worked in overlapping parts
PART_BYTES = 500_000
#: runs that one bucket holds at most; a key of more is spread by the strings of its starts
HOT_RUNS = 2_000
#: bytes from which a passage shared by texts is reported: some 50 short words
PASSAGE = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


# --- suffix array -----------------------------------------------------------


def _names(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Order of the triples at positions ``at``, their names from 1, and whether all differ."""
    top = int(s.max()) + 1
    if top < 1 << 21:
        key = (s[at] * top + s[at + 1]) * top + s[at + 2]
        order = np.argsort(key)
        k = key[order]
        new = k[1:] != k[:-1]
    else:
        order = np.lexsort((s[at + 2], s[at + 1], s[at]))
        a = at[order]
        new = (s[a[1:]] != s[a[:-1]]) | (s[a[1:] + 1] != s[a[:-1] + 1]) | (s[a[1:] + 2] != s[a[:-1] + 2])
    rank = np.concatenate(([1], 1 + np.cumsum(new)))
    names = np.empty(len(at), np.int64)
    names[order] = rank
    return order, names, bool(new.all())


def _merge_rank(one: tuple, zero: tuple) -> np.ndarray:
    """How many of the sorted rows ``one`` come before each of the sorted rows ``zero``; rows are tuples of columns."""
    bits = [max(1, int(max(a.max(initial=0), b.max(initial=0))).bit_length()) for a, b in zip(one, zero, strict=True)]
    if sum(bits) > 62:  # too wide to pack: rank the leading columns together first
        both = np.concatenate
        _, lead = np.unique(both((one[0], zero[0])) * (int(max(one[1].max(initial=0), zero[1].max(initial=0))) + 1) + both((one[1], zero[1])), return_inverse=True)
        n = len(one[0])
        return _merge_rank((lead[:n], *one[2:]), (lead[n:], *zero[2:]))

    def pack(cols: tuple) -> np.ndarray:
        key = cols[0]
        for c, b in zip(cols[1:], bits[1:], strict=True):
            key = (key << b) | c
        return key

    return np.searchsorted(pack(one), pack(zero))


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``values`` (integers from 1) in sorted order."""
    n = len(values)
    if n < 8:
        v = values.tolist()
        return np.array(sorted(range(n), key=lambda i: v[i:]), np.int64)
    m = -(-n // 3) * 3  # padded to a multiple of three; zeros sort before everything
    s = np.zeros(m + 3, np.int64)
    s[:n] = values
    ones, twos = np.arange(1, m, 3), np.arange(2, m, 3)
    sample = np.concatenate((ones, twos))
    order, names, unique = _names(s, sample)
    if not unique:
        order = suffix_array(names)
    sample = sample[order]  # sampled suffixes in order
    rank = np.zeros(m + 3, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    zeros = np.arange(0, m, 3)
    zeros = zeros[np.lexsort((rank[zeros + 1], s[zeros]))]
    first, second = sample[sample % 3 == 1], sample[sample % 3 == 2]
    before = _merge_rank((s[first], rank[first + 1]), (s[zeros], rank[zeros + 1]))
    before = before + _merge_rank((s[second], s[second + 1], rank[second + 2]), (s[zeros], s[zeros + 1], rank[zeros + 2]))
    out = np.empty(m, np.int64)
    slot = np.zeros(m, bool)
    at = before + np.arange(len(zeros))
    slot[at] = True
    out[at], out[~slot] = zeros, sample
    return out[out < n]


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its starts have a ``length``-byte string that starts at another place too."""
    joined = b"\xff".join(contexts) + b"\xff"  # no byte of UTF-8
    text = np.frombuffer(joined, np.uint8)
    n = len(text)
    ends = np.cumsum([len(c) + 1 for c in contexts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    valid = np.zeros(n + 1, np.int64)
    np.add.at(valid, starts, 1)
    np.add.at(valid, np.maximum(starts, ends - length + 1), -1)
    valid = np.cumsum(valid)[:n] > 0
    sa = suffix_array(text.astype(np.int64) + 1)
    a, b = sa[:-1], sa[1:]
    both = valid[a] & valid[b]
    a, b = a[both], b[both]
    wide = np.zeros(n + 8, np.uint64)
    padded = np.zeros(n + 16, np.uint64)
    padded[:n] = text
    for i in range(8):
        wide |= padded[i : i + n + 8] << np.uint64(8 * i)
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        same = wide[a + at] == wide[b + at]
        if not same.all():
            a, b = a[same], b[same]
    hit = np.zeros(n, bool)
    hit[a] = hit[b] = True
    return [hit[s : max(s, e - length + 1)] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


# --- runs -------------------------------------------------------------------


class Hasher:
    """Hashes of all k-mers of a byte array by prefix sums of a polynomial, modulo 2**64."""

    def __init__(self, size: int):
        self.power, self.back = np.full(size + 1, _BASE, np.uint64), np.full(size + 1, _INVERSE, np.uint64)
        self.power[0] = self.back[0] = 1
        np.cumprod(self.power, out=self.power)
        np.cumprod(self.back, out=self.back)

    def sums(self, text: np.ndarray) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.power[: len(text)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
        return _mix((sums[start + k] - sums[start]) * self.back[start])

    def all(self, sums: np.ndarray, k: int) -> np.ndarray:
        return _mix((sums[k:] - sums[:-k]) * self.back[: len(sums) - k])


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours, from running minima of blocks."""
    n = len(v)
    m = -(-n // w) * w
    p = np.full(m, np.iinfo(v.dtype).max, v.dtype)
    p[:n] = v
    blocks = p.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def runs_of(texts: list[bytes], hasher: Hasher, length: int, kmer: int, run: int):
    """(text number, first start, starts, distance of the first start from its anchor, key) of all runs, as arrays.

    The texts are hashed as one array; windows that would cross a text's end are left out.
    """
    joined = b"".join(texts)
    if len(joined) < length:
        return None
    text = np.frombuffer(joined, np.uint8)
    size = np.array([len(t) for t in texts])
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    ok = np.zeros(len(text) + 1, np.int32)
    long = size >= length
    np.add.at(ok, begin[long], 1)
    np.add.at(ok, (begin + size - length + 1)[long], -1)
    ok = np.cumsum(ok)[: len(text) - length + 1] > 0
    if not ok.any():
        return None
    sums = hasher.sums(text)
    v = hasher.all(sums, kmer)
    low = (1 << 24) - 1
    v = (v & ~np.uint64(low)) | np.arange(len(v), dtype=np.uint64)
    start = np.flatnonzero(ok)
    anchor = (_window_min(v, length - kmer + 1)[start] & np.uint64(low)).astype(np.int64)
    block = (anchor - start) // run
    cut = np.concatenate(([True], (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])))
    which = np.searchsorted(begin, start, "right") - 1
    # texts follow each other without a gap where length is 1; empty texts share a begin with the next
    cut[1:] |= which[1:] != which[:-1]
    at = np.flatnonzero(cut)
    count = np.diff(np.concatenate((at, [len(start)])))
    a, b = anchor[at], block[at]
    key = hasher.at(sums, a - run * b, length - run + 1)
    return which[at], start[at] - begin[which[at]], count, a - start[at], (key + b.astype(np.uint64)).view(np.int64)


def settled_here(parts: list[bytes], found: tuple, length: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Runs that an earlier run of the same text equals: (which runs go on, spans that repeat).

    A line or passage that a text holds many times gives as many runs of one key. The
    first of equal runs goes on to meet other texts; what repeats inside the text is
    settled by its bytes and sent on as merged spans.
    """
    which, x, n, back, key = found
    keep, spans = np.ones(len(n), bool), []
    o = np.lexsort((x, n, back, key, which))
    same = np.logical_and.reduce([c[o[1:]] == c[o[:-1]] for c in (which, key, back, n)])
    if not same.any():
        return keep, spans
    repeats: dict[int, set[tuple[int, int]]] = {}
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        w, first = int(which[o[a]]), {}
        for i in o[a : b + 1].tolist():
            span = int(x[i]), int(x[i] + n[i]) + length - 1
            c = parts[w][slice(*span)]
            if c in first:
                keep[i] = False
                repeats.setdefault(w, set()).update((first[c], span))
            else:
                first[c] = span
    for w, found_at in repeats.items():
        at = sorted(found_at)
        s, e = at[0]
        for a, b in at[1:]:
            if a > e:
                spans.append((w, s, e))
                s = a
            e = max(e, b)
        spans.append((w, s, e))
    return keep, spans


#: a run with ``back`` -1 is a span that is settled: x is its start and n its bytes
RUNS = "t1 long, t2 long, x long, n int, back int, key long"


def _emit_runs(length: int, kmer: int, run: int, keys_only: bool = False):
    """Runs of the texts that others may share; with ``keys_only`` each key of a text once, without places."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = None

        def parts(b: pd.DataFrame):
            held, n, seen = [], 0, set()
            for t1, t2, text in zip(b.t1.tolist(), b.t2.tolist(), b.text, strict=True):
                if (t1, t2) in seen:
                    continue
                seen.add((t1, t2))
                data = text.encode()
                for at in range(0, max(1, len(data) - length + 1), PART_BYTES):
                    part = data[at : at + PART_BYTES + length - 1]
                    if len(part) < length:
                        continue
                    if n + len(part) > PART_BYTES + length and held:
                        yield held
                        held, n = [], 0
                    held.append((t1, t2, at, part))
                    n += len(part)
            if held:
                yield held

        for b in batches:
            for held in parts(b):
                hasher = hasher or Hasher(PART_BYTES + 2 * length)
                texts = [p for *_, p in held]
                found = runs_of(texts, hasher, length, kmer, run)
                if found is not None and keys_only:
                    w, key = np.unique(np.stack((found[0], found[4])), axis=1)
                    t1, t2 = (np.array(c, np.int64)[w] for c in zip(*[h[:2] for h in held], strict=True))
                    yield pd.DataFrame({"t1": t1, "t2": t2, "x": 0, "n": np.ones(len(w), np.int32), "back": np.zeros(len(w), np.int32), "key": key})
                elif found is not None:
                    keep, settled = settled_here(texts, found, length)
                    which, x, n, back, key = (c[keep] for c in found)
                    t1, t2, at = (np.array(c, np.int64) for c in zip(*[h[:3] for h in held], strict=True))
                    if settled:
                        w, s, e = np.array(settled, np.int64).T
                        spread = (t1[w] ^ (s.view(np.uint64) * np.uint64(_BASE)).view(np.int64)) & 0x7FFFFFFFFFFFFFFF
                        yield pd.DataFrame({"t1": t1[w], "t2": t2[w], "x": s + at[w], "n": (e - s).astype(np.int32), "back": np.full(len(w), -1, np.int32), "key": spread})
                    yield pd.DataFrame({"t1": t1[which], "t2": t2[which], "x": x + at[which], "n": n.astype(np.int32), "back": back.astype(np.int32), "key": key})

    return work


def _shared_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by (key, t1, t2, x): those of a key that at least two different (text, start) have."""
    last, sent = None, True  # the last distinct row so far, and whether it has been passed on
    for b in batches:
        if not len(b):
            continue
        b = b if last is None else pd.concat([last, b], ignore_index=True)
        k, t1, t2, x = (b[c].to_numpy() for c in ("key", "t1", "t2", "x"))
        new = np.ones(len(b), bool)
        new[1:] = (k[1:] != k[:-1]) | (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1]) | (x[1:] != x[:-1])
        b, k = b[new], k[new]
        same = k[1:] == k[:-1]
        keep = np.concatenate((same, [False])) | np.concatenate(([False], same)) | (b.back.to_numpy() < 0)
        if last is not None and sent:
            keep[0] = False
        passed = keep.copy()
        if last is not None and sent:
            passed[0] = True
        if keep.any():
            yield b[keep]
        last, sent = b.iloc[[-1]], bool(passed[-1])


CONTEXTS = "key long, back int, n int, context binary, holders array<struct<t1:long,t2:long,x:long>>"


def _emit_contexts(length: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found: dict[tuple, list] = {}
            size = 0

            def flush():
                rows = [(k, back, n, c, h) for (k, back, n, c), h in found.items()]
                return pd.DataFrame(rows, columns=["key", "back", "n", "context", "holders"])

            for t1, t2, text, runs in zip(b.t1.tolist(), b.t2.tolist(), b.text, b.runs, strict=True):
                data = text.encode()
                for r in runs:
                    x, n = r["x"], r["n"]
                    c = data[x : x + n + length - 1]
                    k = (r["key"], r["back"], n, c)
                    if k not in found:
                        found[k] = []
                        size += len(c)
                    found[k].append({"t1": t1, "t2": t2, "x": x})
                    if size > 4_000_000:
                        yield flush()
                        found, size = {}, 0
            if found:
                yield flush()

    return work


HOT = "t1 long, t2 long, x long, context binary, h1 array<long>, h2 array<long>"
#: contexts of representatives (some 500 bytes each) that are broadcast at most; more are joined by a shuffle
BROADCAST_CONTEXTS = 10_000
#: parts over which the places of one string of a hot key, and the rows of one text, are dealt
PARTS = 64


def _emit_hot(length: int, mask: int = -1):
    """The given runs with their bytes, and the hashes of both halves of the string at each start."""
    half = length // 2

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(2 * length + RUN)
        for b in batches:
            out = []
            for t1, t2, text, runs in zip(b.t1.tolist(), b.t2.tolist(), b.text, b.runs, strict=True):
                data = text.encode()
                for r in runs:
                    x, n = r["x"], r["n"]
                    context = data[x : x + n + length - 1]
                    sums, at = hasher.sums(np.frombuffer(context, np.uint8)), np.arange(n)
                    h1, h2 = hasher.at(sums, at, half).view(np.int64) & mask, hasher.at(sums, at + half, length - half).view(np.int64) & mask
                    out.append((t1, t2, x, context, h1, h2))
                    if len(out) >= 5_000:
                        yield pd.DataFrame(out, columns=["t1", "t2", "x", "context", "h1", "h2"])
                        out = []
            if out:
                yield pd.DataFrame(out, columns=["t1", "t2", "x", "context", "h1", "h2"])

    return work


def _compared(length: int):
    """Of runs paired with a run of representatives: each start with its representative, and whether the strings are equal."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t1, t2, x, r1, r2, y, at, own, rep in zip(*(b[c] for c in ("t1", "t2", "x", "r1", "r2", "y", "at", "context", "other")), strict=True):
                out += [(t1, t2, x + p["o"], r1, r2, y + p["q"], own[p["o"] : p["o"] + length] == rep[p["q"] : p["q"] + length]) for p in at]
            yield pd.DataFrame(out, columns=["t1", "t2", "x", "r1", "r2", "y", "same"])

    return work


def _part(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS)).alias("part")


def _hot_met(starts: DataFrame) -> DataFrame:
    """The rows of ``starts`` that are not the first place ``r`` of their hashes, each with it and with its ``part``.

    The places of one string, a passage of very many texts, are dealt over ``PARTS`` parts by their runs.
    """
    place = F.struct("t1", "t2", "x", "o")
    dealt = starts.withColumn("part", _part("t1", "t2", "x"))
    parts = dealt.groupBy("h1", "h2", "part").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    groups = parts.groupBy("h1", "h2").agg(F.min("lo").alias("r"), F.max("hi").alias("hi"), F.collect_list("part").alias("parts")).where("r <> hi")
    firsts = groups.select("h1", "h2", F.explode("parts").alias("part"), "r")
    return dealt.join(firsts, ["h1", "h2", "part"]).where(place != F.col("r"))


def _hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """Spans (t1, t2, s, e) of the starts of ``hot`` whose string a second place has."""
    starts = hot.select("t1", "t2", "x", F.posexplode(F.arrays_zip("h1", "h2")).alias("o", "h")).select("t1", "t2", "x", "o", "h.h1", "h.h2")
    spans = None
    while True:  # a second turn only where different strings have equal hashes
        met = _hot_met(starts)
        pairs = met.select("t1", "t2", "x", "part", F.col("r.t1").alias("r1"), F.col("r.t2").alias("r2"), F.col("r.x").alias("y"), F.struct("o", F.col("r.o").alias("q")).alias("at"))
        pairs = stored(pairs.groupBy("t1", "t2", "x", "part", "r1", "r2", "y").agg(F.collect_list("at").alias("at")))  # as many as a run has starts
        reps = pairs.select("r1", "r2", "y").distinct().join(hot.select(F.col("t1").alias("r1"), F.col("t2").alias("r2"), F.col("x").alias("y"), F.col("context").alias("other")), ["r1", "r2", "y"])
        reps, on = stored(reps), ["r1", "r2", "y"]
        if reps.count() <= BROADCAST_CONTEXTS:
            reps = F.broadcast(reps)
        else:  # a copy for each part that asks for it
            reps, on = pairs.select(*on, "part").distinct().join(reps, on), [*on, "part"]
        both = pairs.join(hot.select("t1", "t2", "x", "context"), ["t1", "t2", "x"]).join(reps, on)
        told = stored(both.mapInPandas(_compared(length), "t1 long, t2 long, x long, r1 long, r2 long, y long, same boolean"))
        equal = told.where("same")
        found = equal.select("t1", "t2", F.col("x").alias("s")).unionAll(equal.select("r1", "r2", "y").distinct()).withColumn("e", F.col("s") + length)
        spans = found if spans is None else spans.unionAll(found)
        left = told.where("NOT same").select("t1", "t2", F.col("x").alias("_x"))
        if left.isEmpty():
            return spans
        at = F.col("x") + F.col("o")
        starts = stored(starts.withColumn("_x", at).join(left, ["t1", "t2", "_x"], "left_semi").drop("_x"))


SPANS = "t1 long, t2 long, s long, e long"


def _sorted_bucket(rows: list[tuple], length: int, run: int, limit: int) -> Iterator[tuple]:
    """Work of one bucket. rows: (start relative to the anchor, starts, context, holders). Yields sets of rows to sort together, or rows that repeat whole."""
    merged: dict[tuple, set] = {}
    for rel, n, c, h in rows:
        merged.setdefault((rel, n, c), set()).update(h)
    alone = []
    for (rel, n, c), h in merged.items():
        if len(h) > 1:
            yield "whole", (n, h)
        alone.append((rel, n, c, h))
    if len(alone) < 2:  # equal strings lie equally far from their anchors, so one run has none twice
        return
    if sum(len(c) for _, _, c, _ in alone) <= limit or run == 1:
        if any(len(h) == 1 for *_, h in alone):
            yield "sort", alone
        return
    # too much for one sort: windows of half the starts share more bytes
    low = min(r[0] for r in alone)
    half = (run + 1) // 2
    for r0, r1 in ((low, low + half), (low + half, low + run)):
        groups: dict[bytes, list] = {}
        for rel, n, c, h in alone:
            x, y = max(rel, r0), min(rel + n, r1)
            if x < y:
                moved = {(a, b, at + x - rel) for a, b, at in h}
                groups.setdefault(c[r1 - 1 - rel : r0 + length - rel], []).append((x, y - x, c[x - rel : y - rel + length - 1], moved))
        for part in groups.values():
            if len(part) > 1:
                yield from _sorted_bucket(part, length, r1 - r0, limit)


def _find_spans(length: int, run: int, limit: int):
    """Streams contexts sorted by key; yields the byte spans that go."""

    def spans(n: int, hit: np.ndarray, holders) -> Iterator[tuple]:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            for t1, t2, x in holders:
                yield t1, t2, x + s, x + e - 1 + length

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        pool, pool_bytes = [], 0
        key, rows = None, []

        def sort_pool():
            # buckets of one sort hold different strings, so they cannot mix
            for (_, n, _, h), hit in zip(pool, repeated_starts([r[2] for r in pool], length), strict=True):
                out.extend(spans(n, hit, h))

        def close():
            nonlocal pool, pool_bytes
            for what, x in _sorted_bucket(rows, length, run, limit):
                if what == "whole":
                    n, h = x
                    out.extend((t1, t2, s, s + n - 1 + length) for t1, t2, s in h)
                    continue
                size = sum(len(r[2]) for r in x)
                if pool and pool_bytes + size > limit:
                    sort_pool()
                    pool, pool_bytes = [], 0
                pool += x
                pool_bytes += size

        for b in batches:
            for k, back, n, c, h in zip(b.key.tolist(), b.back.tolist(), b.n.tolist(), b.context, b.holders, strict=True):
                if k != key:
                    if rows:
                        close()
                    key, rows = k, []
                rows.append((-back, n, bytes(c), [(r["t1"], r["t2"], r["x"]) for r in h]))
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["t1", "t2", "s", "e"])
                out = []
        if rows:
            close()
        if pool:
            sort_pool()
        if out:
            yield pd.DataFrame(out, columns=["t1", "t2", "s", "e"])

    return work


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])))
def _union(lists: pd.Series) -> pd.Series:
    """Overlapping and touching spans joined, sorted."""

    def one(spans) -> list[dict]:
        s = np.array(sorted((x["s"], x["e"]) for x in spans), np.int64).reshape(-1, 2)
        far = np.maximum.accumulate(s[:, 1])
        first = np.concatenate(([True], s[1:, 0] > far[:-1]))
        ends = far[np.concatenate((np.flatnonzero(first)[1:] - 1, [len(s) - 1]))]
        return [{"s": int(a), "e": int(b)} for a, b in zip(s[first, 0], ends, strict=True)]

    return lists.map(one)


def _texts(named: DataFrame) -> DataFrame:
    """(t1, t2, rep, copies, parts): each text of ``named(doc_id, t1, t2, part)`` once, with its least id and its number of rows."""
    parts = named.groupBy("t1", "t2", "part").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    return parts.groupBy("t1", "t2").agg(F.min("rep").alias("rep"), F.sum("copies").alias("copies"), F.collect_list("part").alias("parts"))


def _copied(named: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, t1, t2): the rows of texts that several rows hold, met in their parts as one text may have very many."""
    many = texts.where("copies > 1").select("t1", "t2", F.explode("parts").alias("part"))
    return named.join(many, ["t1", "t2", "part"]).select("doc_id", "t1", "t2")


def repeated_spans(docs: DataFrame, length: int = LENGTH, kmer: int = KMER, run: int = RUN, limit: int = SORT_BYTES, hot: int = HOT_RUNS, mask: int = -1) -> DataFrame:
    """(doc_id, t1, t2, copied, spans): texts that lose bytes.

    copied: the text (at least ``length`` bytes) occurs in more than one row and
    goes whole. Else ``spans`` are the maximal removed byte ranges [s, e). t1 and t2
    are two hashes of the text that identify it. Repeated rows are copies of each
    other. Null text is empty. ``mask`` weakens the hashes of hot keys, for tests.
    """
    d = docs.select("doc_id", body().alias("text"))
    t1, t2 = F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(3), F.col("text")).alias("t2")
    long = d.where(F.octet_length("text") >= length)
    named = long.select("doc_id", t1, t2, _part("doc_id"))
    texts = stored(_texts(named))
    runs = long.select(t1, t2, "text").mapInPandas(_emit_runs(length, kmer, run), RUNS)
    order = ["key", "t1", "t2", "x"]
    shared = stored(runs.repartition("key").sortWithinPartitions(*order).mapInPandas(_shared_runs, RUNS))
    settled = shared.where("back < 0").select("t1", "t2", F.col("x").alias("s"), (F.col("x") + F.col("n")).alias("e"))
    open_ = shared.where("back >= 0")

    def with_text(runs: DataFrame) -> DataFrame:
        by_text = runs.groupBy("t1", "t2").agg(F.collect_list(F.struct("x", "n", "back", "key")).alias("runs"))
        by_text = by_text.join(texts, ["t1", "t2"]).select("t1", "t2", "rep", "runs")
        fetched = long.join(by_text, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("t1"))).where(F.xxhash64(F.lit(3), F.col("text")) == F.col("t2"))
        return fetched.select("t1", "t2", "text", "runs")

    # a key of very many runs would be one bucket; its starts are spread by what they hold instead
    hot_keys = stored(open_.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"))
    if not hot_keys.isEmpty():
        found = stored(with_text(open_.join(hot_keys, "key", "left_semi")).mapInPandas(_emit_hot(length, mask), HOT))
        settled = settled.unionByName(_hot_spans(found, length))
        open_ = open_.join(hot_keys, "key", "left_anti")
    contexts = with_text(open_).mapInPandas(_emit_contexts(length), CONTEXTS)
    found = contexts.repartition("key").sortWithinPartitions("key").mapInPandas(_find_spans(length, run, limit), SPANS)
    # a text with copies goes whole, whatever else was found in it
    once = texts.where("copies = 1").select("t1", "t2", F.col("rep").alias("doc_id"))
    spans = stored(found).unionByName(settled).groupBy("t1", "t2").agg(F.collect_set(F.struct("s", "e")).alias("s")).join(once, ["t1", "t2"])
    spans = spans.select("doc_id", "t1", "t2", F.lit(False).alias("copied"), _union("s").alias("spans"))
    copied = _copied(named, texts).distinct()
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return spans.unionByName(copied.select("doc_id", "t1", "t2", F.lit(True).alias("copied"), none.alias("spans")))


@F.pandas_udf(T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]))
def _cut(text: pd.Series, copied: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for t, c, s in zip(text, copied, spans, strict=True):
        data = t.encode()
        if c is not None and c:
            rows.append((len(data), 1, b""))
        elif s is None or not len(s):
            rows.append((0, 0, data))
        else:
            cuts = [0, *(v for x in s for v in (x["s"], x["e"])), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
            rows.append((len(data) - len(kept), len(s), kept))
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])


def shared_passages(docs: DataFrame, length: int = PASSAGE) -> DataFrame:
    """(doc_id, t1, t2, n_passages): places of each text that a different row's text holds as well, where there are any.

    Places are runs as in :func:`repeated_spans`, told by the hash of the three quarters of
    ``length`` bytes that their windows share. Every string of ``length`` bytes that two
    texts hold makes a place in both; strings below three quarters of it make none. A text
    that several rows hold has one place more. Nothing is removed for this.
    """
    kmer, run = length // 4, length // 4 + 1
    d = docs.select("doc_id", body().alias("text")).where(F.octet_length(body()) >= length)
    t1, t2 = F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(3), F.col("text")).alias("t2")
    keys = d.select(t1, t2, "text").mapInPandas(_emit_runs(length, kmer, run, keys_only=True), RUNS)
    shared = keys.repartition("key").sortWithinPartitions("key", "t1", "t2", "x").mapInPandas(_shared_runs, RUNS)
    places = shared.groupBy("t1", "t2").agg(F.count("*").alias("n"))
    rows = stored(d.select("doc_id", t1, t2).groupBy("doc_id", "t1", "t2").agg(F.count("*").alias("copies")))
    copies = rows.groupBy("t1", "t2").agg(F.sum("copies").alias("copies")).where("copies > 1").select("t1", "t2", F.lit(1).cast("long").alias("n"))
    found = stored(places.unionByName(copies).groupBy("t1", "t2").agg(F.sum("n").alias("n_passages")))
    return rows.join(found, ["t1", "t2"]).select("doc_id", "t1", "t2", "n_passages")


def without_repeats(docs: DataFrame, length: int = LENGTH, kmer: int = KMER, run: int = RUN, limit: int = SORT_BYTES, passage: int | None = None, hot: int = HOT_RUNS, mask: int = -1) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and the remaining bytes as ``kept`` (a cut may split a character).

    Null and empty texts have 0 bytes and lose none. Extra columns pass through. With
    ``passage`` also n_passages: places shared with other texts over some ``passage`` bytes,
    below ``length`` as well, which are reported and not removed (:func:`shared_passages`).
    """
    docs, restored = set_aside(docs, ("doc_id", "text"))
    gone = repeated_spans(docs, length, kmer, run, limit, hot, mask)
    outputs = ["n_bytes", "n_removed", "n_spans", "kept"]
    if passage:
        told = shared_passages(docs, passage).select(F.col("doc_id").alias("_id"), F.col("t1").alias("_a"), F.col("t2").alias("_b"), "n_passages")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_a")) & (F.col("t2") == F.col("_b"))
        gone = stored(gone).join(told, same, "full")
        gone = gone.select(F.coalesce("doc_id", "_id").alias("doc_id"), F.coalesce("t1", "_a").alias("t1"), F.coalesce("t2", "_b").alias("t2"), "copied", "spans", "n_passages")
        outputs.append("n_passages")
    gone = gone.withColumnsRenamed({"doc_id": "_d", "t1": "_t1", "t2": "_t2", "copied": "_copied", "spans": "_spans"})
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64(body()) == F.col("_t1")) & (F.xxhash64(F.lit(3), body()) == F.col("_t2"))
    d = docs.join(gone, same, "left").withColumn("n_bytes", F.octet_length(body()).cast("long"))
    d = d.withColumn("_cut", _cut(body(), F.col("_copied"), F.col("_spans")))
    d = d.withColumns({c: F.col(f"_cut.{c}") for c in ("n_removed", "n_spans", "kept")})
    if passage:
        d = d.withColumn("n_passages", F.coalesce("n_passages", F.lit(0).cast("long")))
    return restored(d, outputs)
