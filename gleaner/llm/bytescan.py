"""Array kernels over the UTF-8 bytes of text columns (used inside tasks).

A batch of texts is one flat ``uint8`` array plus document offsets; words,
shingles and fixed-length strings get 64-bit hashes from prefix sums of a
polynomial modulo 2**64 over random byte values. Distinct strings share a hash
with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUE = BYTE_VALUE[LOWER]
GAP = np.zeros(256, dtype=bool)
GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

CHUNK_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse to the powers 0..n-1."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES * 2)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(raw: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole documents of about
    ``size`` bytes; a longer document is a chunk of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, word ends, words before each document and in all)."""
    inside = ~GAP[raw]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    heads = offsets[:-1]
    heads = heads[heads < len(raw)]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    tails = offsets[1:] - 1
    after[tails[tails >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = LOWER_VALUE) -> np.ndarray:
    """64-bit hash of each word; ``values`` folds A-Z unless told otherwise."""
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values[raw] * up[:-1], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """For each document, its sorted distinct hashes of ``k`` consecutive words;
    with fewer words, the whole sequence counts as one; without words, none."""
    n = len(hashes)
    both = hashes[:max(0, n - k + 1)].copy()
    for j in range(1, k):
        both = mix(both) + hashes[j:n - k + 1 + j] if len(both) else both
    both = mix(both + U64(k)) if len(both) else both
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(both[a:b - k + 1]))
        elif b > a:
            one = hashes[a:a + 1].copy()
            for j in range(a + 1, b):
                one = mix(one) + hashes[j:j + 1]
            out.append(mix(one + U64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
