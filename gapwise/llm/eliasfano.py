"""Elias-Fano sequences of sorted 64-bit integers, searched in place by whole arrays of queries."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_NTH = np.zeros((256, 9), np.uint8)                     # position of a byte's k-th set bit
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _NTH[_b, _k] = _p
_NONE, _ALL = U64(0), U64(2 ** 64 - 1)


def _pad(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8)


def encode(values: np.ndarray) -> bytes:
    """Bytes of a non-decreasing uint64 array: header, low bits, high bits in unary, ones and zeros before each 64 of them."""
    n = len(values)
    base = int(values[0]) if n else 0
    v = values - U64(base)
    span = int(v[-1]) if n else 0
    bits = min(56, max(0, (span // max(n, 1)).bit_length() - 1))
    low = np.zeros((n * bits + 63) // 64 + 2, U64)
    if n and bits:
        at = np.arange(n, dtype=U64) * U64(bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        part = v & U64((1 << bits) - 1)
        np.add.at(low, word, part << shift)
        over = shift + U64(bits) > U64(64)
        np.add.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
    size = n + (span >> bits) + 1
    high = np.zeros(-(-size // 64) * 64, bool)
    if n:
        high[(v >> U64(bits)).astype(np.int64) + np.arange(n)] = True
    packed = np.packbits(high, bitorder="little").view(U64)
    ones = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]))
    zeros = np.arange(len(packed)) * 64 - ones
    kind = _kind(len(packed))
    head = np.array([n, bits, base, span, len(low), len(packed)], U64)
    return (head.tobytes() + low.tobytes() + packed.tobytes()
            + _pad(ones.astype(kind).tobytes()) + _pad(zeros.astype(kind).tobytes()))


def _kind(words: int) -> type:
    return np.uint32 if words < 1 << 26 else np.uint64


class EliasFano:
    """A view of :func:`encode`'s bytes at an offset of a buffer, which may be memory-mapped."""

    def __init__(self, buffer: np.ndarray, at: int = 0):
        head = buffer[at: at + 48].view(U64)
        self.n, self.bits, self.base, self.span = (int(x) for x in head[:4])
        low, words = int(head[4]), int(head[5])
        kind = np.dtype(_kind(words))
        self.low = buffer[at + 48: at + 48 + 8 * low].view(U64)
        at += 48 + 8 * low
        self.high = buffer[at: at + 8 * words].view(U64)
        at += 8 * words
        size = words * kind.itemsize
        self.ones = buffer[at: at + size].view(kind)
        at += size + -size % 8
        self.zeros = buffer[at: at + size].view(kind)
        self.end = at + size + -size % 8

    def _select(self, k: np.ndarray, counts: np.ndarray, flip: np.uint64) -> np.ndarray:
        """Position of the k-th one, or of the k-th zero where all bits are flipped."""
        word = np.searchsorted(counts, k.astype(counts.dtype), side="right") - 1
        rest = (k - counts[word].astype(np.int64)).astype(np.uint8)
        bits, inside = self.high[word] ^ flip, np.zeros(len(k), np.uint8)
        for half in (32, 16, 8):
            lower = bits & U64((1 << half) - 1)
            ones = np.bitwise_count(lower)
            up = rest >= ones
            rest -= ones * up
            bits = np.where(up, bits >> U64(half), lower)
            inside += np.uint8(half) * up
        return (word << 6) + (inside + _NTH[bits.astype(np.intp), rest])

    def _after(self, at: np.ndarray, flip: np.uint64) -> np.ndarray:
        """How many bits from each position on are alike before the first one that is set, after all bits are flipped by ``flip``; 64: none of 64 is."""
        word, shift = at >> 6, (at & 63).astype(U64)
        bits = (self.high[word] ^ flip) >> shift
        rest = np.flatnonzero((bits == 0) & (word + 1 < len(self.high)))       # none up to the word's end
        more = self.high[word[rest] + 1] ^ flip
        bits[rest] = more << U64(1) << U64(63) - shift[rest]
        return np.bitwise_count((bits & -bits) - U64(1)).astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        bit = i * self.bits
        word, shift = bit >> 6, (bit & 63).astype(U64)
        raw = self.low[word] >> shift | self.low[word + 1] << U64(1) << U64(63) - shift
        return raw & U64((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values by index."""
        i = np.asarray(i, np.int64)
        high = self._select(i, self.ones, _NONE) - i
        return (high.astype(U64) << U64(self.bits) | self._low(i)) + U64(self.base)

    def pair(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values by index, and those that follow them."""
        at = self._select(i, self.ones, _NONE)
        gap = self._after(at + 1, _NONE)
        far = np.flatnonzero(gap == 64)
        after = at + 1 + gap
        after[far] = self._select(i[far] + 1, self.ones, _NONE)
        return tuple(((p - k).astype(U64) << U64(self.bits) | self._low(k)) + U64(self.base) for p, k in ((at, i), (after, i + 1)))

    def successor(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value at or above each query, and whether it equals the query."""
        q = np.asarray(q, U64)
        at, equal = np.zeros(len(q), np.int64), np.zeros(len(q), bool)
        if not self.n or not len(q):
            return at, equal
        x = q - U64(self.base)                                       # those below the base wrap around
        inside = (q >= U64(self.base)) & (x <= U64(self.span))
        if inside.all():
            return self._within(x)
        at[q > U64(self.base)] = self.n
        some = np.flatnonzero(inside)
        at[some], equal[some] = self._within(x[some])
        return at, equal

    def _within(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`successor` of distances from the base that are not beyond the last value's."""
        bucket, low = (x >> U64(self.bits)).astype(np.int64), x & U64((1 << self.bits) - 1)
        begin = self._select(np.maximum(bucket - 1, 0), self.zeros, _ALL) + 1 - bucket
        begin[bucket == 0] = 0
        size = self._after(begin + bucket, _ALL)
        many = np.flatnonzero(size == 64)
        size[many] = self._select(bucket[many], self.zeros, _ALL) - bucket[many] - begin[many]
        at, equal = begin, np.zeros(len(x), bool)
        some = np.flatnonzero(size)
        first, left, low = begin[some], size[some], low[some]
        while True:                              # the sought one is among the ``left`` ones from ``first`` on, or follows them
            more = np.flatnonzero(left > 1)
            if not len(more):
                break
            half, from_ = left[more] >> 1, first[more]
            first[more] = from_ + half * (self._low(from_ + half - 1) < low[more])
            left[more] -= half
        found = self._low(first)
        at[some], equal[some] = first + (found < low), found == low
        return at, equal
