"""Word shingles of whole texts as 64-bit hashes, a slice of texts at a time.

Words are maximal runs of bytes other than the six ASCII white-space
characters, with A-Z lower-cased. All words of a slice are hashed at once by
a polynomial over the bytes (a prefix sum and modular inverses), and the
hashes of ``size`` neighbouring words are mixed into a shingle's hash. The
hashes depend on nothing but the words, so they agree on all executors.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Buckets of a table in which shingles are counted, and the bits of the hash that name them in each table.
BUCKETS = 1 << 18
SHIFTS = (0, 24)
_IS_WORD = np.array([c not in b" \t\n\v\f\r" for c in range(256)])


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    n = 1 << bits
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, length in bytes, text number) of each word of these texts, in order."""
    joined = b" ".join(raws).translate(_LOWER)
    b = np.frombuffer(joined, np.uint8)
    inside = _IS_WORD[b]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    start, end = edges[::2], edges[1::2]
    up, down = _powers(max(22, int(len(b)).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], dtype=np.uint64)])
    h = mix((total[end] - total[start]) * down[start])
    first = np.cumsum([0, *(len(x) + 1 for x in raws)])
    return h, end - start, np.searchsorted(first, start, side="right") - 1


def shingles(raws: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, length in bytes, text number) of each shingle with repeats; a text
    with fewer than ``size`` words, but not none, has its whole sequence as one."""
    h, n, text = words(raws)
    count = np.bincount(text, minlength=len(raws)) if len(raws) else np.zeros(0, np.int64)
    last = np.cumsum(count)
    # full windows: the word and its size - 1 followers lie in one text
    at = np.flatnonzero(np.arange(len(h)) + size <= last[text]) if len(h) else np.zeros(0, np.int64)
    out, length = np.full(len(at), size, np.uint64), np.zeros(len(at), np.int64)
    for k in range(size):
        out = mix(out + h[at + k])
        length += n[at + k]
    # short texts
    short = np.flatnonzero((count > 0) & (count < size))
    more, more_length = [], []
    for t in short.tolist():
        v = np.full(1, count[t], np.uint64)
        for k in range(last[t] - count[t], last[t]):
            v = mix(v + h[k:k + 1])
        more.append(v[0])
        more_length.append(int(n[last[t] - count[t]:last[t]].sum()))
    return (np.concatenate([out, np.array(more, np.uint64)]), np.concatenate([length, np.array(more_length, np.int64)]),
            np.concatenate([text[at], short]))


def buckets(h: np.ndarray) -> tuple[np.ndarray, ...]:
    """A shingle's bucket in each of the tables of counts."""
    return tuple((h >> np.uint64(shift) & np.uint64(BUCKETS - 1)).astype(np.int64) for shift in SHIFTS)


class Order:
    """A global order of shingles: frequent ones come last (by their count),
    before that long ones come first; then the hash. ``counts`` has, for each
    table, the shingles of all texts by bucket; a shingle's smaller count, less
    what a bucket holds on average, counts, and from ``least`` on it is frequent.
    Any total order gives right results; this one puts rare shingles in front."""

    def __init__(self, counts: np.ndarray | None = None, least: int = 1):
        self.rank = None
        if counts is not None:
            self.rank = np.maximum(counts - counts.sum(1, keepdims=True) // BUCKETS, 0)
            self.rank[self.rank < least] = 0

    def key(self, h: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Sort key (ties are broken by the hash)."""
        rank = np.zeros(len(h), np.uint64)
        if self.rank is not None:
            rank = np.minimum(np.minimum.reduce([table[at] for table, at in zip(self.rank, buckets(h))]), 1 << 40).astype(np.uint64)
        return (rank << np.uint64(16)) | (65535 - np.minimum(length, 65535)).astype(np.uint64)

    def sets(self, raws: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """(distinct shingle hashes of all texts, each text's in the global
        order; offset of each text plus the end)."""
        h, length, text = shingles(raws, size)
        at = np.lexsort((h, self.key(h, length), text))
        h, text = h[at], text[at]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        h, text = h[new], text[new]
        return h, np.searchsorted(text, np.arange(len(raws) + 1))
