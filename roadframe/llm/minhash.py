"""ProbMinHash signatures of weighted word shingles, in Arrow batches.

Every shingle sends a Poisson process of arrivals with rate equal to its
weight; an arrival falls on a random register, and a register keeps the
shingle of its earliest arrival. Two texts agree on a register with
probability equal to their probability Jaccard similarity. A shingle stops as
soon as its next arrival is later than every register's earliest one, so a
text costs its shingles plus a few arrivals per register.

Near-duplicate search weighs a shingle by its distinct words ("no no no no no"
says less than five words do). That weight is the shingle's own, the same in
every text, so the probability Jaccard similarity of two texts is the weight
of their common shingles over that of all their shingles.
"""

from __future__ import annotations

import numpy as np

from roadframe.llm.words import Words, mix64

SHINGLE = 5
REGISTERS = 100


#: bits of a shingle hash; the rest of a sort key numbers the text
_HASH_BITS = 50
#: the lowest of them hold the number of the shingle's distinct words
KIND_BITS = 3


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text: ``(text, hash, weight)``, sorted by
    text and hash; the weight is 1 + ln(number of times), and the hash's low
    KIND_BITS bits are the number of distinct words (``kinds``). A text of fewer than
    ``size`` words is one shingle of all of them; one without words has none."""
    counts = words.counts
    if not len(words.code):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    with np.errstate(over="ignore"):
        word = mix64(words.hashes())[words.code]
        starts = np.maximum(counts - size + 1, np.minimum(counts, 1))
        owner = np.repeat(np.arange(len(counts)), starts)
        place = np.arange(len(owner)) + np.repeat(words.offsets[:-1] - (np.cumsum(starts) - starts), starts)
        end = words.offsets[1:][owner]
        value = np.zeros(len(owner), np.uint64)
        different = np.zeros(len(owner), np.uint64)
        for i in range(size):
            at = place + i
            inside = at < end
            code = words.code[np.minimum(at, len(word) - 1)]
            new = inside.copy()
            for k in range(i):
                new &= words.code[place + np.minimum(k, end - place - 1)] != code
            different += new
            step = np.where(inside, word[np.minimum(at, len(word) - 1)], np.uint64(i + 1))
            value = (value ^ step) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        value = mix64(value) >> np.uint64(64 - _HASH_BITS) & ~np.uint64((1 << KIND_BITS) - 1) | different
        key = value | owner.astype(np.uint64) << np.uint64(_HASH_BITS)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key, times = key[at], np.diff(np.append(at, len(key)))
    owner = (key >> np.uint64(_HASH_BITS)).astype(np.int64)
    return owner, key & np.uint64((1 << _HASH_BITS) - 1), 1.0 + np.log(times)


def kinds(value: np.ndarray) -> np.ndarray:
    """Number of distinct words of each shingle, its weight in the search."""
    return value & value.dtype.type((1 << KIND_BITS) - 1)


def signatures(n: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray,
               registers: int = REGISTERS) -> np.ndarray:
    """``n`` rows of ``registers`` shingle hashes; zeros for texts without shingles."""
    early = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, np.uint64)
    low = np.uint64((1 << 32) - 1)
    time = np.zeros(len(owner))
    first, step = owner * registers, np.uint64(0)
    with np.errstate(over="ignore"):
        while len(owner):
            step += np.uint64(1)
            draw = mix64(value ^ step * np.uint64(0x9E3779B97F4A7C15))
            time = time - np.log(((draw >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0 ** -32) / weight
            cell = first + ((draw & low) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            sooner = np.flatnonzero(time < early[cell])
            at, when = cell[sooner], time[sooner]
            np.minimum.at(early, at, when)
            won = when == early[at]
            kept[at[won]] = value[sooner[won]]
            latest = early.reshape(n, registers).max(axis=1)
            alive = np.flatnonzero(time < latest[owner])
            owner, value, weight, time, first = owner[alive], value[alive], weight[alive], time[alive], first[alive]
    return kept.reshape(n, registers)
