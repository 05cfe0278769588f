"""A double array over phrases of word codes, walked from many places at once
(used inside tasks).

Symbols are the bytes of the codes. A child of state ``s`` under symbol ``c``
lies at ``base[s] ^ c`` and names its parent in ``check``; the children of a
state share a block of 256 slots, in which the exclusive or moves them freely.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 256
_OPEN = 6  # partly filled blocks that a large family of children is tried in
_SMALL = 8
_SHIFTS = np.arange(_BLOCK)


def symbols_per_code(top: int) -> int:
    """Bytes that a code up to ``top`` needs."""
    return max(1, -(-int(top).bit_length() // 8))


class PhraseTrie:
    """Phrases as rows of a matrix of codes (distinct, all of one length)."""

    def __init__(self, phrases: np.ndarray, n_symbols: int):
        self.n_symbols, self.depth = n_symbols, phrases.shape[1] if phrases.ndim == 2 else 0
        order = np.lexsort(phrases.T[::-1]) if len(phrases) else np.zeros(0, np.int64)
        self._build(phrases[order], order)

    def _build(self, rows: np.ndarray, order: np.ndarray) -> None:
        shifts = range(8 * (self.n_symbols - 1), -1, -8)
        columns = [(rows[:, w] >> s) & 255 for w in range(self.depth) for s in shifts]
        n = len(rows)
        node, total = np.zeros(n, np.int64), 1  # the node each phrase is at; node 0 is the root
        parents, symbols = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for symbol in columns:
            new = np.ones(n, dtype=bool)
            new[1:] = (node[1:] != node[:-1]) | (symbol[1:] != symbol[:-1])
            parents.append(node[new])
            symbols.append(symbol[new])
            node = total + np.cumsum(new) - 1
            total += int(np.count_nonzero(new))
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)
        slot, base = self._place(parent, symbol, total)
        size = (int(slot.max()) // _BLOCK + 1) * _BLOCK if total else _BLOCK
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.leaf = np.full(size, -1, np.int32)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent[1:]]
        self.leaf[slot[node]] = order

    @staticmethod
    def _place(parent: np.ndarray, symbol: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """(slot, base) of every node. Families of more than _SMALL children go
        one by one into the first open block with a fitting shift, largest
        first; small ones draw blocks and shifts all at once until each has
        found free slots; only children take one each of the slots left."""
        slot, base = np.zeros(total, np.int64), np.zeros(total, np.int64)
        # nodes are numbered level by level, so a node's children are neighbours
        heads = np.flatnonzero(np.concatenate([[True], parent[2:] != parent[1:-1]])) + 1 if total > 1 else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, total))
        blocks = [np.zeros(_BLOCK, dtype=bool)]
        blocks[0][0] = True  # the root
        open_ = [0]
        for f in np.argsort(-counts, kind="stable")[:np.count_nonzero(counts > _SMALL)]:
            family = slice(heads[f], heads[f] + counts[f])
            places = _SHIFTS[:, None] ^ symbol[family][None, :]
            for b in open_:
                fits = np.flatnonzero(~blocks[b][places].any(axis=1))
                if len(fits):
                    break
            else:
                b, fits = len(blocks), [0]
                blocks.append(np.zeros(_BLOCK, dtype=bool))
                open_ = [*open_[1:], b] if len(open_) == _OPEN else [*open_, b]
            shift = int(fits[0])
            blocks[b][places[shift]] = True
            base[parent[heads[f]]] = b * _BLOCK | shift
            slot[family] = b * _BLOCK + places[shift]
        small = (counts > 1) & (counts <= _SMALL)
        n_blocks = len(blocks) + 3 * (int(counts[small].sum()) // _BLOCK + 1)
        taken = np.zeros(n_blocks * _BLOCK, dtype=bool)
        taken[:len(blocks) * _BLOCK] = np.concatenate(blocks)
        left, draw = np.flatnonzero(small), np.random.default_rng(len(heads))
        owner = np.zeros(len(taken), np.int64)
        while len(left):
            sizes = counts[left]
            first = np.cumsum(sizes) - sizes
            children = np.repeat(heads[left] - first, sizes) + np.arange(sizes.sum())
            at = draw.integers(0, len(taken), len(left))
            target = np.repeat(at, sizes) ^ symbol[children]
            mine = np.repeat(left, sizes)
            owner[target] = mine
            ok = np.logical_and.reduceat(~taken[target] & (owner[target] == mine), first)
            won = np.repeat(ok, sizes)
            taken[target[won]] = True
            slot[children[won]] = target[won]
            base[parent[heads[left[ok]]]] = at[ok]
            left = left[~ok]
        single = heads[counts == 1]
        free = np.flatnonzero(~taken)
        extra = len(single) - len(free)
        if extra > 0:
            free = np.concatenate([free, len(taken) + np.arange(extra)])
        free = free[:len(single)]
        slot[single] = free
        base[parent[single]] = free ^ symbol[single]
        return slot, base

    def walk(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, phrase) of every occurrence in a run of codes; all places
        move a symbol at a time, and those without a child drop out."""
        places = np.arange(max(0, len(codes) - self.depth + 1))
        state = np.zeros(len(places), np.int32)
        for w in range(self.depth):
            for s in range(8 * (self.n_symbols - 1), -1, -8):
                child = self.base[state] ^ ((codes[places + w] >> s) & 255)
                ok = self.check[child] == state
                places, state = places[ok], child[ok]
        return places, self.leaf[state]
