"""Static range asymmetric numeral system for token ids, vectorised over lanes.

A block's tokens stand in rows of ``lanes`` tokens; lane ``k`` codes column
``k`` with its own 64-bit state. The encoder goes from the last row to the
first, the decoder from the first to the last; both agree on the order of the
32-bit words that the states give out. A checkpoint holds the states and the
word position before a row, so decoding may start there.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE_BITS = 20
LANES = 2048
#: rows between two checkpoints, if not given
CHECKPOINT_ROWS = 256
_LOW = 31  # states stay at or above 2**31
_MAGIC = b"RANS\x01"
_HEAD = "<5sIII"  # magic, tokens, lanes, checkpoints


@dataclass
class Table:
    """Shared frequencies: they sum to 2**SCALE_BITS over the symbols in use."""

    symbols: np.ndarray
    frequency: np.ndarray

    def __post_init__(self):
        self.start = np.concatenate(([0], np.cumsum(self.frequency)[:-1])).astype(np.uint64)
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 1
        self.index = np.zeros(size, np.int64)
        self.index[self.symbols] = np.arange(len(self.symbols))
        self.slot = np.repeat(np.arange(len(self.symbols)), self.frequency.astype(np.int64))
        self.frequency = self.frequency.astype(np.uint64)

    @staticmethod
    def from_counts(symbols: np.ndarray, counts: np.ndarray) -> Table:
        """Scale counts so that every symbol in use keeps at least one slot."""
        order = np.argsort(symbols)
        symbols, counts = symbols[order].astype(np.int64), counts[order].astype(np.float64)
        if not len(symbols):
            return Table(symbols, np.zeros(0, np.int64))
        whole = 1 << SCALE_BITS
        if len(symbols) > whole:
            raise ValueError("more symbols than slots")
        share = 1 + np.floor(counts / counts.sum() * (whole - len(symbols))).astype(np.int64)
        share[counts.argmax()] += whole - share.sum()
        return Table(symbols, share)


def encode(tokens: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT_ROWS) -> bytes:
    """One block with header, a checkpoint ``every`` so many rows, words and a checksum."""
    n = len(tokens)
    lanes = max(1, min(lanes, n))
    rows = -(-n // lanes)
    index = table.index[tokens]
    state = np.full(lanes, 1 << _LOW, np.uint64)
    words: list[np.ndarray] = []
    marks, given = [], 0
    scale, wide = np.uint64(SCALE_BITS), np.uint64(32)
    for row in range(rows - 1, -1, -1):
        at = index[row * lanes:(row + 1) * lanes]
        f, x = table.frequency[at], state[:len(at)]
        full = x >= f << np.uint64(_LOW - SCALE_BITS + 32)
        out = x[full].astype(np.uint32)
        words.append(out)
        given += len(out)
        x[full] >>= wide
        quotient = x // f
        state[:len(at)] = (quotient << scale) + (x - quotient * f) + table.start[at]
        if row % every == 0:
            marks.append((row, given, state.copy()))
    marks.reverse()
    body = [struct.pack(_HEAD, _MAGIC, n, lanes, len(marks))]
    for row, before, states in marks:
        body.append(struct.pack("<II", row, given - before) + states.tobytes())
    body.extend(w.tobytes() for w in reversed(words))
    block = b"".join(body)
    return block + struct.pack("<I", zlib.crc32(block))


def parts(block: bytes, tokens: int) -> list[tuple[int, bytes]]:
    """A block cut at checkpoints into blocks of about ``tokens`` tokens, each
    with its first token's place; they decode without one another."""
    if zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("block checksum does not match")
    _, n, lanes, count = struct.unpack_from(_HEAD, block)
    size, base = 8 + 8 * lanes, struct.calcsize(_HEAD)
    marks = [struct.unpack_from("<II", block, base + i * size) for i in range(count)]
    step = max(1, tokens // (lanes * marks[1][0])) if count > 1 else 1
    words = base + count * size
    end = (len(block) - 4 - words) // 4
    out = []
    for first in range(0, count, step):
        last = min(first + step, count)
        (row, place), (stop, until) = marks[first], marks[last] if last < count else (-(-n // lanes), end)
        body = [struct.pack(_HEAD, _MAGIC, min(stop * lanes, n) - row * lanes, lanes, last - first)]
        for i in range(first, last):
            states = block[base + i * size + 8:base + (i + 1) * size]
            body.append(struct.pack("<II", marks[i][0] - row, marks[i][1] - place) + states)
        body.append(block[words + 4 * place:words + 4 * until])
        whole = b"".join(body)
        out.append((row * lanes, whole + struct.pack("<I", zlib.crc32(whole))))
    return out


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Tokens of a block, or of its checkpoints ``first`` up to ``last``."""
    if zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("block checksum does not match")
    magic, n, lanes, count = struct.unpack_from(_HEAD, block)
    if magic != _MAGIC:
        raise ValueError("not a block")
    if n == 0:
        return np.zeros(0, np.int64)
    size = 8 + 8 * lanes
    base = struct.calcsize(_HEAD)
    words = np.frombuffer(block, np.uint32, offset=base + count * size, count=(len(block) - 4 - base - count * size) // 4)
    row, place = struct.unpack_from("<II", block, base + first * size)
    state = np.frombuffer(block, np.uint64, lanes, base + first * size + 8).copy()
    rows = -(-n // lanes)
    stop = rows if last is None or last >= count else struct.unpack_from("<I", block, base + last * size)[0]
    out = np.zeros(min(stop * lanes, n) - row * lanes, np.int64)
    mask, scale, wide = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    floor, done = np.uint64(1 << _LOW), 0
    while row < stop:
        width = min(lanes, n - row * lanes)
        x = state[:width]
        low = x & mask
        at = table.slot[low.astype(np.int64)]
        out[done:done + width] = at
        x = table.frequency[at] * (x >> scale) + low - table.start[at]
        short = np.flatnonzero(x < floor)
        x[short] = x[short] << wide | words[place:place + len(short)]
        place += len(short)
        state[:width] = x
        done += width
        row += 1
    return table.symbols[out]
