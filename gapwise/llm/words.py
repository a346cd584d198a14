"""Hashing of words and word shingles straight from Arrow string buffers.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z count as a-z.
All hashes are 64 bits and depend on the word's bytes only.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

U64 = np.uint64
_BLOCK = 1 << 16          # bytes hashed at once, which also bounds the tables of powers that every worker holds
_LONG = 1 << 16           # longer words are hashed one by one

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_POW = np.cumprod(np.full(_BLOCK + _LONG + 1, _BASE, U64))
_INV = np.cumprod(np.full(_BLOCK + _LONG + 1, pow(_BASE, -1, 1 << 64), U64))
_STEP = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                 U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 bounds of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if offsets else \
        np.zeros(1, np.int64)
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(data, np.uint8)[bounds[0]: bounds[-1]]
    return buf, bounds - bounds[0]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 2,000 rows from now on, unless the session already differs from Spark's 10,000.

    A row is a whole text, so that a default batch of long texts would take
    much of a Python worker's memory.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "2000")


@cache
def _c_library() -> ctypes.CDLL:
    return ctypes.CDLL(None)


def trim() -> None:
    """Give memory that is free back to the system, where the allocators can; else a worker keeps its peak while other tasks run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):        # not glibc
        _c_library().malloc_trim(0)


def slices(batch: pa.RecordBatch, text: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``most`` bytes of text (one row at least)."""
    _, bounds = text_buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
        trim()


def word_hashes(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each text bound the index of the first word at or after it."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(bounds), np.int64)
    space = _IS_SPACE[buf]
    edge = np.ones(n + 1, bool)               # a word may begin here / the previous one must end
    edge[1:n] = space[:-1]
    edge[bounds] = True
    start = np.flatnonzero(edge[:n] & ~space)
    edge[:n] = space
    edge[n] = True
    edge[bounds] = True
    end = np.flatnonzero(edge[1:] & ~space) + 1
    out = np.empty(len(start), U64)
    size = end - start
    at = 0
    while at < len(start):
        if size[at] > _LONG:
            raw = buf[start[at]: end[at]].tobytes().lower()
            out[at] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
            at += 1
            continue
        to = int(np.searchsorted(end, start[at] + _BLOCK, side="right"))
        to = max(to, at + 1)
        lo = int(start[at])
        span = slice(lo, int(end[to - 1]))
        sums = np.zeros(span.stop - lo + 1, U64)
        np.cumsum(_BYTE[buf[span]] * _POW[: span.stop - lo], out=sums[1:])
        out[at:to] = mix((sums[end[at:to] - lo] - sums[start[at:to] - lo]) * _INV[start[at:to] - lo]
                         + size[at:to].astype(U64))
        for i in np.flatnonzero(size[at:to] > _LONG) + at:
            raw = buf[start[i]: end[i]].tobytes().lower()
            out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        at = to
    return out, np.searchsorted(start, bounds)


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles.

    A text with 1 to k-1 words has one shingle, its whole sequence; one without words has none.
    """
    n = len(words)
    rows = np.zeros(n, U64)
    for i in range(min(k, n)):
        rows[: n - i] += words[i:] * _STEP[i % 5] * U64(2 * (i // 5) + 1)
    rows = mix(rows)
    for a, b in zip(first[:-1], first[1:]):
        m = int(b - a)
        if m >= k:
            yield np.unique(rows[a: b - k + 1])
        elif m:
            own = words[a:b] * _STEP[np.arange(m) % 5] * (np.arange(m, dtype=U64) // U64(5) * U64(2) + U64(1))
            yield mix(own.sum(keepdims=True, dtype=U64) + np.array([m], U64) * U64(0xC2B2AE3D27D4EB4F))
        else:
            yield np.zeros(0, U64)
