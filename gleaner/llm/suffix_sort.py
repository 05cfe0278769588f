"""Suffix arrays by induced sorting, over arrays of small integers.

Suffixes are classed as larger (L) or smaller (S) than their right neighbour.
The leftmost S of each run start substrings that are sorted by inducing,
named, and, where names repeat, sorted by their own suffix array (recursively;
a reduced text with a large alphabet by doubling). The order of these starts
then induces that of all suffixes in two linear passes over the buckets. A
bucket's suffixes induce their neighbours block by block, so the passes run on
arrays.
"""

from __future__ import annotations

import numpy as np

#: Alphabets above this are sorted by doubling: a bucket pass would be too many small steps.
MAX_BUCKETS = 4096


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one, the unique
    least symbol, is."""
    n = len(text)
    step = np.sign(text[1:] - text[:-1])
    at = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # next position with a different neighbour
    out = np.ones(n, dtype=bool)
    out[:-1] = step[np.minimum(nearest, n - 2)] > 0
    return out


def _deal(rows: np.ndarray, symbols: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows by symbol, stable; with each row's rank in its symbol and the counts."""
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    counts = np.bincount(symbols, minlength=buckets)
    starts = np.cumsum(counts) - counts
    return rows[order], symbols, np.arange(len(rows)) - starts[symbols], counts


def _induce(text: np.ndarray, small: np.ndarray, sorted_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, buckets = len(text), len(sizes)
    tail = np.cumsum(sizes)
    head = tail - sizes
    suffixes = np.full(n, -1, dtype=np.int64)
    rows, symbols, rank, counts = _deal(sorted_starts, text[sorted_starts], buckets)
    first = tail - counts
    suffixes[first[symbols] + rank] = rows
    fill = head.copy()
    for c in range(buckets):
        done = head[c]
        while done < fill[c]:  # the larger suffixes of this bucket, as far as they are known
            block = suffixes[done:fill[c]]
            done = fill[c]
            _place_larger(text, small, block, suffixes, fill, buckets)
        if counts[c]:
            _place_larger(text, small, suffixes[first[c]:tail[c]], suffixes, fill, buckets)
    end_of_larger = fill.copy()
    for c in range(buckets):
        if counts[c]:
            suffixes[first[c]:tail[c]] = -1
    suffixes[0] = n - 1  # the unique least symbol
    fill = tail.copy()
    for c in range(buckets - 1, 0, -1):
        done = tail[c]
        while done > fill[c]:
            block = suffixes[fill[c]:done][::-1]
            done = fill[c]
            _place_smaller(text, small, block, suffixes, fill, buckets)
        if end_of_larger[c] > head[c]:
            _place_smaller(text, small, suffixes[head[c]:end_of_larger[c]][::-1], suffixes, fill, buckets)
    return suffixes


def _place_larger(text, small, block, suffixes, fill, buckets):
    before = block - 1
    before = before[before >= 0]
    before = before[~small[before]]
    if len(before):
        rows, symbols, rank, counts = _deal(before, text[before], buckets)
        suffixes[fill[symbols] + rank] = rows
        fill += counts


def _place_smaller(text, small, block, suffixes, fill, buckets):
    before = block - 1
    before = before[before >= 0]
    before = before[small[before]]
    if len(before):
        rows, symbols, rank, counts = _deal(before, text[before], buckets)
        suffixes[fill[symbols] - 1 - rank] = rows
        fill -= counts


def _names(text: np.ndarray, starts: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings, in order of ``ordered``."""
    length = np.zeros(len(text), dtype=np.int64)
    length[starts[:-1]] = starts[1:] - starts[:-1] + 1
    length[starts[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    j = 0
    while len(live):
        differ = text[a[live] + j] != text[b[live] + j]
        same[live[differ]] = False
        j += 1
        live = live[~differ]
        live = live[length[a[live]] > j]
    return np.concatenate([[0], np.cumsum(~same)])


def _by_doubling(text: np.ndarray) -> np.ndarray:
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of an int64 array whose last symbol is its unique least, 0."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    sizes = np.bincount(text)
    if len(sizes) > MAX_BUCKETS:
        return _by_doubling(text)
    small = _smaller(text)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(starts) > 1:
        first = _induce(text, small, starts, sizes)
        is_start = np.zeros(n, dtype=bool)
        is_start[starts] = True
        ordered = first[is_start[first]]
        names = _names(text, starts, ordered)
        if names[-1] + 1 < len(starts):
            name_at = np.zeros(n, dtype=np.int64)
            name_at[ordered] = names
            ordered = starts[suffix_array(name_at[starts])]
        starts = ordered
    return _induce(text, small, starts, sizes)


def common_prefix_reaches(text: np.ndarray, suffixes: np.ndarray, length: int, where: np.ndarray) -> np.ndarray:
    """Permuted common prefixes, as far as needed: for each text position,
    whether it shares ``length`` symbols with its predecessor in the suffix
    array. Only positions set in ``where`` are looked at; those must have
    ``length`` symbols. ``text`` has byte values."""
    previous = np.full(len(text), -1, dtype=np.int64)
    previous[suffixes[1:]] = suffixes[:-1]
    packed = np.zeros(len(text) + 8, dtype=np.uint64)
    for j in range(8):
        packed[:len(text) - j] |= text[j:].astype(np.uint64) << np.uint64(8 * j)
    at = np.flatnonzero(where & (previous >= 0) & (previous + length <= len(text)))
    with_ = previous[at]
    for j in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        same = packed[at + j] == packed[with_ + j]
        at, with_ = at[same], with_[same]
    out = np.zeros(len(text), dtype=bool)
    out[at] = True
    return out
