"""White-space words of an Arrow text column as flat numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: rows and bytes of text handled at once inside a task
SLICE_ROWS = 1000
SLICE_BYTES = 2 << 20


def release() -> None:
    """Hand freed memory back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU C library only
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: int, most_rows: int = SLICE_ROWS,
           most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of bounded text size (a longer text stands alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > most_bytes or i - start >= most_rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


class Words:
    """Words of each text: ``code`` per place into ``unique``; the words of
    text ``i`` stand at ``offsets[i]:offsets[i + 1]``. Null texts have none."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        filled = pc.fill_null(texts.cast(pa.large_string()), "")
        if lower:
            filled = pc.utf8_lower(filled)
        # the split leaves empty strings at the ends of a padded text
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(filled))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        encoded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        self.offsets = offsets - offsets[0]
        self.unique = encoded.dictionary
        self.code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.index(self.unique, "").as_py()
        if empty >= 0:  # an empty text splits into one empty word
            keep = self.code != empty
            kept = np.concatenate(([0], np.cumsum(keep)))
            self.offsets, self.code = kept[self.offsets], self.code[keep]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def owner(self) -> np.ndarray:
        """Index of the text of every place."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every unique word."""
        import xxhash

        found = [xxhash.xxh3_64_intdigest(w, seed) for w in self.unique.cast(pa.large_binary()).to_pylist()]
        return np.array(found, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
