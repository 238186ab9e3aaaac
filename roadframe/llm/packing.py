"""Best-fit packing of token sequences by exact-complement hashing.

Only the lengths decide a packing, and there are at most ``capacity`` of them.
So the plan is made on the histogram of lengths, whose size does not depend on
the corpus: bins of equal content are handled together; a bin's gap is closed
by one, two or three available lengths that sum to it exactly, and where no
such combination is left the longest length that fits goes in and the new gap
is tried again. The pieces then find their places by rank within their length,
in one pass over the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import ordered, read_table, ship_package, stored
from roadframe.llm.tokens import BYTES, ROWS, VOCABULARY, encoder
from roadframe.llm.words import release, slices

CAPACITY = 4096
END_ID = 1


class Gaps:
    """Availability counts by length, with exact-sum look-ups."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two available lengths of this sum; of such pairs the one with most copies."""
        if total < 2:
            return None
        half = total // 2
        short, rest = self.left[1:half + 1], self.left[total - half:total][::-1]
        both = np.minimum(short, rest)
        if total % 2 == 0:
            both[-1] //= 2  # a length paired with itself
        best = int(both.argmax())
        return (total - 1 - best, best + 1) if both[best] > 0 else None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``gap``."""
        if self.left[gap] > 0:
            return (gap,)
        if found := self.pair(gap):
            return found
        for first in np.flatnonzero(self.left[:gap - 1])[::-1].tolist():
            if 3 * first < gap:  # the longest of three is at least a third
                break
            self.left[first] -= 1
            found = self.pair(gap - first)
            self.left[first] += 1
            if found:
                return (first, *found)
        return None

    def fitting(self, gap: int) -> int | None:
        """The longest available length up to ``gap``."""
        found = np.flatnonzero(self.left[:gap + 1])
        return int(found[-1]) if len(found) else None

    def copies(self, lengths: tuple[int, ...]) -> int:
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """``(number of bins, lengths in each)`` that use every length exactly as
    often as ``counts[length]`` says."""
    gaps, bins = Gaps(counts), []
    for longest in range(capacity, 0, -1):
        # its equals may stand in the same bins, so open a share of them at a time
        share = 1 if 2 * longest > capacity else capacity // longest + 1
        while gaps.left[longest]:
            times = -(-int(gaps.left[longest]) // share)
            gaps.take((longest,), times)
            _fill(gaps, bins, times, (longest,), capacity - longest)
    return bins


def _fill(gaps: Gaps, bins: list, times: int, held: tuple[int, ...], gap: int) -> None:
    open_bins = [(times, held, gap)]
    while open_bins:
        times, held, gap = open_bins.pop()
        while times:
            found = gaps.exact(gap) if gap else ()
            if found is not None:
                n = min(times, gaps.copies(found)) if found else times
                gaps.take(found, n)
                bins.append((n, held + found))
            elif longest := gaps.fitting(gap):
                n = min(times, int(gaps.left[longest]))
                gaps.take((longest,), n)
                open_bins.append((n, held + (longest,), gap - longest))
            else:
                n = times
                bins.append((n, held))
            times -= n


def slots(bins: list[tuple[int, tuple[int, ...]]], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places by rank, for pieces ordered by length: rank ``r`` with
    ``first[i] <= r < first[i + 1]`` goes to sequence ``base[i] + r`` at
    ``offset[i]``."""
    following = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    rows, sequence = [], 0
    for times, lengths in bins:
        offset = 0
        for x in lengths:
            rows.append((following[x], sequence - following[x], offset))
            following[x] += times
            offset += x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's ids with
    the end id, cut at ``capacity`` where longer."""
    ship_package(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, ROWS, BYTES)):
            rows: list[tuple] = []
            found = encoder(vocabulary).encode_all(batch.column(1), end_id)
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids = ids.astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part)))
            doc_ids, pieces, starts, lengths, sums = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    Null and empty texts are the end id alone; a null ``doc_id`` stays null;
    repeated rows are packed each; other columns are ignored; an empty table
    gives no rows. Every piece is in exactly one sequence and each sequence is
    filled from 0 without gaps. Pieces of one length are interchangeable, so a
    very common length costs nothing extra: ranks come from a range sort.
    """
    # stored first: the range sort samples its input, and texts are encoded once
    pieces = stored(token_pieces(docs, capacity, end_id, vocabulary), "token-pieces")
    keys = [F.col("length"), F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("doc_id"), F.col("piece")]
    placed = ordered(pieces, keys, "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in placed.groupBy("length").count().collect():  # at most `capacity` rows
        counts[row["length"]] = row["count"]
    # bound: a few rows for every length, whatever the corpus size
    first, base, offset = slots(plan_bins(counts, capacity), counts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            at = np.searchsorted(first, rank, side="right") - 1
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(base[at] + rank), pa.array(offset[at])],
                                             names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return placed.select(*names, "rank").mapInArrow(place, schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 4096 ids; see ``pack``."""
    return pack(read_table(spark, sf_dir, "documents"))
