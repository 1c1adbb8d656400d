"""XXH64 of word shingles, for the texts of a batch at once.

A loop over shingles spends most of its time in calls. Here the words of all texts lie in
one buffer, a shingle is a span of it, and the rounds of the hash run over all spans side
by side, each on the spans that are long enough for it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: spans worked at once, so that the arrays stay in the processor's cache
STEP = 1 << 14
#: bytes of text joined in one buffer; a longer text has one of its own
PART_BYTES = 2_000_000


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * P2, 31) * P1


def hash_spans(data: bytes, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each span ``data[start : start + size]``."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    words = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))  # the eight bytes from every place
    out = np.empty(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(start), STEP):
            out[at : at + STEP] = _hash_block(words, start[at : at + STEP], size[at : at + STEP], np.uint64(seed))
    return out


def _hash_block(words: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.uint64) -> np.ndarray:
    h = np.full(len(start), seed + P5)
    long = np.flatnonzero(size >= 32)
    if len(long):
        lanes = [np.full(len(long), s) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        stripes = size[long] // 32
        for k in range(int(stripes.max())):
            on = np.flatnonzero(stripes > k)
            at = start[long[on]] + 32 * k
            for i in range(4):
                lanes[i][on] = _round(lanes[i][on], words[at + 8 * i])
        acc = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for v in lanes:
            acc = (acc ^ _round(np.uint64(0), v)) * P1 + P4
        h[long] = acc
    h += size.astype(np.uint64)
    rest = size % 32
    at = start + size - rest
    for k in range(3):
        on = np.flatnonzero(rest >= 8 * (k + 1))
        h[on] = _turn(h[on] ^ _round(np.uint64(0), words[at[on] + 8 * k]), 27) * P1 + P4
    at, rest = at + (rest & ~7), rest & 7
    on = np.flatnonzero(rest >= 4)
    h[on] = _turn(h[on] ^ ((words[at[on]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    at, rest = at + (rest & 4), rest & 3
    for k in range(3):
        on = np.flatnonzero(rest > k)
        h[on] = _turn(h[on] ^ ((words[at[on] + k] & np.uint64(0xFF)) * P5), 11) * P1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    return h ^ (h >> np.uint64(32))


def shingle_hashes(texts: Sequence[str], width: int, seed: int = 42) -> Iterator[np.ndarray]:
    """For each text the hashes of its shingles of ``width`` words, repeats included.

    Words are lower-cased in A-Z and parted by the six ASCII spaces. A text of fewer words
    is one shingle, one without words has none.
    """
    held: list[bytes] = []
    n = 0
    for t in texts:
        held.append(b" ".join(t.encode().lower().split()))  # bytes: A-Z and the six ASCII spaces only
        n += len(held[-1])
        if n > PART_BYTES:
            yield from _hashed(held, width, seed)
            held, n = [], 0
    yield from _hashed(held, width, seed)


def _hashed(held: list[bytes], width: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of texts whose words are parted by single spaces."""
    count = np.array([t.count(b" ") + 1 if t else 0 for t in held], np.int64)
    data = b" ".join([t for t in held if t])
    ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data))
    begins = np.append(0, ends[:-1] + 1)
    shingles = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    # the first word of each shingle, and its last one
    first_word = np.cumsum(count) - count
    of = np.repeat(np.arange(len(held)), shingles)
    rank = np.arange(len(of)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    low = first_word[of] + rank
    high = low + np.minimum(width, count[of]) - 1
    start = begins[low] if len(low) else low
    hashes = hash_spans(data, start, (ends[high] if len(high) else high) - start, seed)
    yield from np.split(hashes, np.cumsum(shingles)[:-1]) if held else ()


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes set, as an unsigned integer; 0 without hashes."""
    ones, step = np.zeros(64, np.int64), 1 << 16
    for i in range(0, len(hashes), step):
        ones += np.unpackbits(hashes[i : i + step].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")
