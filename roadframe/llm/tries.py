"""Double-array tries over bytes: built on the driver from a bounded set of
keys, broadcast, and walked by numpy for many positions at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: parents with more children than this get a block of 256 slots of their own
WIDE = 24


class DoubleArray:
    """Slot ``base[s] + symbol`` is the child of state ``s`` by ``symbol`` if
    its ``check`` is ``s``. A state is a slot; 0 is the root. ``value`` is what
    an accepting state stands for, -1 elsewhere.

    Symbols are bytes, so a parent has 256 children at most. A trie of ``E``
    edges takes 12 bytes for each of ``1.6 E`` + 2^11 slots, and for 256 more
    for every parent over ``WIDE``.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, values: np.ndarray, seed: int = 0):
        """Key ``i`` is ``data[offsets[i]:offsets[i + 1]]``; keys are distinct."""
        parent, symbol, last = _edges(offsets.astype(np.int64), data)
        count = len(parent)
        children = np.bincount(parent, minlength=count + 1)
        base, size = _places(parent, symbol, children, np.random.default_rng(seed))
        slot = np.zeros(count + 1, np.int64)  # edge e leads to node e + 1
        slot[1:] = base[parent] + symbol
        self.base = np.zeros(size, np.int32)
        self.base[slot] = base
        self.check = np.full(size, -1, np.int32)
        self.check[slot[1:]] = slot[parent]
        self.value = np.full(size, -1, np.int32)
        self.value[slot[last]] = values

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next state of every position, -1 where there is none."""
        found = self.base[states] + symbols.astype(np.int64)
        return np.where(self.check[found] == states, found, -1)

    def walk(self, levels: Sequence[np.ndarray], states: np.ndarray | None = None) -> np.ndarray:
        """State of every position after one symbol of each level, -1 for dead
        ones; positions that died are not advanced any more."""
        n = len(levels[0])
        out = np.full(n, -1, np.int64)
        alive = np.arange(n)
        states = np.zeros(n, np.int64) if states is None else states
        for symbols in levels:
            states = self.step(states, symbols[alive])
            kept = states >= 0
            alive, states = alive[kept], states[kept]
        out[alive] = states
        return out

    def look_up(self, offsets: np.ndarray, data: np.ndarray, start: int = 0) -> np.ndarray:
        """Values of the byte strings ``data[offsets[i]:offsets[i + 1]]`` from
        the state ``start`` on, -1 where one is no key."""
        offsets = offsets.astype(np.int64)
        sizes = np.diff(offsets)
        out = np.full(len(sizes), -1, np.int64)
        alive, states = np.arange(len(sizes)), np.full(len(sizes), start, np.int64)
        level = 0
        while len(alive):
            ended = sizes[alive] == level
            out[alive[ended]] = self.value[states[ended]]
            alive, states = alive[~ended], states[~ended]
            states = self.step(states, data[offsets[alive] + level])
            kept = states >= 0
            alive, states, level = alive[kept], states[kept], level + 1
        return out

    def state(self, key: bytes) -> int:
        """State after a prefix, -1 if no key begins so."""
        state = 0
        for symbol in key:
            state = int(self.step(np.array([state]), np.array([symbol]))[0])
            if state < 0:
                break
        return state


def _edges(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and symbol of every edge, level by level, and every key's node."""
    sizes = np.diff(offsets)
    node = np.zeros(len(sizes), np.int64)
    parents, symbols, count, level = [], [], 0, 0
    alive = np.flatnonzero(sizes > 0)
    while len(alive):
        codes, place = np.unique(node[alive] * 256 + data[offsets[alive] + level], return_inverse=True)
        parents.append(codes >> 8)
        symbols.append(codes & 255)
        node[alive] = count + 1 + place
        count, level = count + len(codes), level + 1
        alive = alive[sizes[alive] > level]
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return flat(parents), flat(symbols), node


def _places(parent: np.ndarray, symbol: np.ndarray, children: np.ndarray,
            random: np.random.Generator) -> tuple[np.ndarray, int]:
    """A base for every node so that no two edges share a slot. Wide nodes lie
    in blocks of their own; the others, wide before narrow, draw bases at
    random, all at once, until every one has found free slots."""
    wide = np.flatnonzero(children > WIDE)
    size = len(parent) * 8 // 5 + 256 * (len(wide) + 1) + 2048
    base = np.zeros(len(children), np.int64)
    base[wide] = 256 * (1 + np.arange(len(wide)))
    taken = np.zeros(size, bool)
    taken[0] = True  # the root
    inside = children[parent] > WIDE
    taken[base[parent[inside]] + symbol[inside]] = True
    order = np.argsort(parent, kind="stable")
    first = np.concatenate(([0], np.cumsum(children)))
    claim = np.zeros(size, np.int64)
    most = WIDE
    while most >= 1:
        least = most // 2
        todo = np.flatnonzero((children > least) & (children <= most))
        while len(todo):
            counts = children[todo]
            owner = np.repeat(np.arange(len(todo)), counts)
            starts = np.cumsum(counts) - counts
            edge = order[first[todo][owner] + np.arange(counts.sum()) - starts[owner]]
            draw = random.integers(0, size - 255, len(todo))
            slots = draw[owner] + symbol[edge]
            claim[slots] = owner
            good = ~taken[slots] & (claim[slots] == owner)
            placed = np.bincount(owner, ~good, len(todo)) == 0
            base[todo[placed]] = draw[placed]
            taken[slots[placed[owner]]] = True
            todo = todo[~placed]
        most = least
    return base, size
