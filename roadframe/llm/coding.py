"""Token files: whole texts as entropy-coded token blocks in document order.

A folder holds ``table`` (the shared frequencies) and ``blocks`` (Parquet
files whose rows carry one coded block each with its documents' ids and
lengths), both on the shared storage of the cluster. A block holds whole
documents and is decoded without any other block. The block of a very long
document is cut at its checkpoints, and the parts are decoded by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import rans
from roadframe.llm.common import read_table, ship_package, shuffle_partitions, stored
from roadframe.llm.tokens import VOCABULARY, encoder
from roadframe.llm.words import release, slices
from roadframe.session import fresh_shared_path

END_ID = 2
#: rows and bytes of text encoded at once: a long slice repeats more of its words
ROWS, BYTES = 8000, 8 << 20
#: a block closes once it has this many tokens (a longer document stands alone)
BLOCK_TOKENS = 1 << 19
#: rows of lanes between two checkpoints, which take 8 bytes a lane
CHECKPOINT_ROWS = 64
#: a block of more tokens is decoded in parts, by several tasks
LONG_BLOCK = 2 * BLOCK_TOKENS
#: ``part`` numbers the sorted partition, ``before`` counts its ids before the block
BLOCK_SCHEMA = "part long, before long, tokens long, doc_ids array<long>, lengths array<int>, block binary"


def token_rows(docs: DataFrame, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """``place, doc_id, before, ids`` in ascending doc_id order (null first,
    equal ids by text hash); ``place`` holds the sorted partition above 33
    bits, ``before`` counts the ids before a document in its partition."""
    ship_package(docs.sparkSession)
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        shuffle_partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys).select(
        F.monotonically_increasing_id().alias("place"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0  # a task is one sorted partition
        for batch in (part for whole in batches for part in slices(whole, 2, ROWS, BYTES)):
            kind = encoder(vocabulary).dtype
            ids = [a.tobytes() for a in encoder(vocabulary).encode_all(batch.column(2), end_id)]
            ends = total + np.cumsum([len(x) // kind.itemsize for x in ids], dtype=np.int64)
            before = np.concatenate(([total], ends[:-1])) if len(ids) else ends
            total = int(ends[-1]) if len(ids) else total
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(before), pa.array(ids, pa.binary())],
                names=["place", "doc_id", "before", "ids"])
        release()

    return placed.mapInArrow(run, "place long, doc_id long, before long, ids binary")


def id_counts(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, count`` over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, total = encoder(vocabulary).dtype, np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(found) > len(total):
                found, total = total, found
            total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "count"])

    parts = tokens.select("ids").mapInArrow(run, "id long, count long")
    return parts.groupBy("id").agg(F.sum("count").alias("count"))


def load_table(spark: SparkSession, path: str) -> rans.Table:
    """The shared frequencies; at most one row per id of the vocabulary."""
    found = spark.read.schema("id long, frequency long").parquet(f"{path}/table").orderBy("id").collect()
    return rans.Table(np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.int64))


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, vocabulary: str = VOCABULARY,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode all ``docs`` into the folder ``path``."""
    spark = docs.sparkSession
    tokens = stored(token_rows(docs, end_id, vocabulary), "tokens")
    counts = id_counts(tokens, vocabulary).collect()  # at most the vocabulary
    table = rans.Table.from_counts(np.array([r["id"] for r in counts], np.int64),
                                   np.array([r["count"] for r in counts], np.int64))
    spark.createDataFrame([(int(s), int(f)) for s, f in zip(table.symbols, table.frequency, strict=True)],
                          "id long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    held = spark.sparkContext.broadcast((table.symbols, table.frequency.astype(np.int64)))

    def pack(rows: list[tuple], kind: np.dtype, table: rans.Table) -> pa.RecordBatch:
        ids = [np.frombuffer(r[3], kind) for r in rows]
        lengths = [len(x) for x in ids]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[0][0] >> 33], pa.int64()), pa.array([rows[0][2]], pa.int64()),
            pa.array([sum(lengths)], pa.int64()),
            pa.array([[r[1] for r in rows]], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
            pa.array([rans.encode(np.concatenate(ids), table, every=CHECKPOINT_ROWS)], pa.binary())],
            names=["part", "before", "tokens", "doc_ids", "lengths", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, coder = encoder(vocabulary).dtype, rans.Table(*held.value)
        rows, size, before = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                # a read task may hold several stored partitions; a block holds one
                if rows and (size >= block_tokens * kind.itemsize or row[0] >> 33 != before):
                    yield pack(rows, kind, coder)
                    rows, size = [], 0
                rows.append(row)
                size, before = size + len(row[3]), row[0] >> 33
        if rows:
            yield pack(rows, kind, coder)

    tokens.mapInArrow(run, BLOCK_SCHEMA).write.option(
        "compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, ids: bool = True, long_block: int = LONG_BLOCK) -> DataFrame:
    """Decode a folder: ``doc_id, start, n_tokens, ids_crc32, ids`` (ids as
    little-endian unsigned 32-bit integers, and their checksum); ``start``
    counts the ids of all documents before. ``ids=False`` keeps the decoded
    ids in the workers and returns the other columns. Blocks of more than
    ``long_block`` tokens are decoded in parts of a quarter of that, by
    different tasks."""
    ship_package(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum("tokens")).orderBy("part").collect()  # one row per sorted partition
    first = dict(zip((r[0] for r in sizes), np.cumsum([0, *(r[1] for r in sizes)])[:-1].tolist(), strict=True))
    table = load_table(spark, path)
    held = spark.sparkContext.broadcast((table.symbols, table.frequency.astype(np.int64), first))

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, frequency, first = held.value
        coder = rans.Table(symbols, frequency)
        for batch in batches:
            for part, before, doc_ids, lengths, block in zip(
                    *(batch.column(i).to_pylist() for i in range(5)), strict=True):
                decoded = rans.decode(block, coder).astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                start = first[part] + before + ends - lengths
                parts = [decoded[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array(start), pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()), *([pa.array(parts, pa.binary())] if ids else [])],
                    names=names)

    columns = ["part", "before", "doc_ids", "lengths", "block"]
    whole = blocks.where(F.col("tokens") <= long_block).select(*columns).mapInArrow(run, schema)
    cut = cut_blocks(blocks.where(F.col("tokens") > long_block).select(*columns), long_block // 4)
    return whole.unionByName(_read_parts(cut.repartition(shuffle_partitions(spark), "part", "before", "place"), held, ids))


def cut_blocks(blocks: DataFrame, tokens: int) -> DataFrame:
    """Parts of blocks, of about ``tokens`` tokens, with the documents that
    they reach into: ``nth`` is the first one's number in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, doc_ids, lengths, block in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                ends = np.cumsum(lengths)
                cut = rans.parts(block, tokens)
                places = [p for p, _ in cut] + [int(ends[-1])]
                for (place, piece), end in zip(cut, places[1:], strict=True):
                    a, b = int(np.searchsorted(ends, place, side="right")), int(np.searchsorted(ends, end, side="left")) + 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part]), pa.array([before]), pa.array([place], pa.int64()), pa.array([a], pa.int64()),
                        pa.array([doc_ids[a:b]], pa.list_(pa.int64())), pa.array([lengths[a:b]], pa.list_(pa.int32())),
                        pa.array([int(ends[a] - lengths[a])], pa.int64()), pa.array([piece], pa.binary())],
                        names=["part", "before", "place", "nth", "doc_ids", "lengths", "begins", "piece"])

    return blocks.mapInArrow(run, "part long, before long, place long, nth long, doc_ids array<long>, lengths array<int>, "
                                  "begins long, piece binary")


def _read_parts(cut: DataFrame, held, ids: bool) -> DataFrame:
    """Documents of cut blocks: each part is decoded where it lies, and the
    pieces of a document are joined, or only their checksums."""
    key = "part long, before long, nth long, doc_id long, start long, n_tokens long, at long, size long, crc long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, frequency, first = held.value
        coder = rans.Table(symbols, frequency)
        for batch in batches:
            for part, before, place, nth, doc_ids, lengths, begins, piece in zip(
                    *(batch.column(i).to_pylist() for i in range(8)), strict=True):
                decoded = rans.decode(piece, coder).astype("<u4").tobytes()
                ends = begins + np.cumsum(lengths)
                rows = []
                for k, (doc_id, n, end) in enumerate(zip(doc_ids, lengths, ends.tolist(), strict=True)):
                    a, b = max(end - n, place), min(end, place + len(decoded) // 4)
                    found = decoded[4 * (a - place):4 * (b - place)]
                    rows.append((part, before, nth + k, doc_id, first[part] + before + end - n, n, a, b - a,
                                 zlib.crc32(found), found if ids else b""))
                kinds = [pa.int64()] * 9 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(10)],
                                                 names=[f.split(" ")[0] for f in key.split(", ")])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        crc = 0
        for size, own in zip(table.column("size").to_pylist(), table.column("crc").to_pylist(), strict=True):
            crc = joined_crc32(crc, own, 4 * size)
        one = {name: table.column(name)[:1] for name in ("doc_id", "start", "n_tokens")}
        one["ids_crc32"] = pa.array([crc], pa.int64())
        if ids:
            one["ids"] = pa.array([b"".join(table.column("ids").to_pylist())], pa.binary())
        return pa.table(one)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    return cut.mapInArrow(run, key).groupBy("part", "before", "nth").applyInArrow(join, schema)


def joined_crc32(one: int, two: int, size: int) -> int:
    """The crc32 of two strings put together, from theirs and the second's
    size: the first is shifted by so many zero bytes, by repeated squaring of
    the shift as a matrix of bits."""

    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    shift = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):  # eight of them
        shift = [times(shift, row) for row in shift]
    while size:
        if size & 1:
            one = times(shift, one)
        shift = [times(shift, row) for row in shift]
        size >>= 1
    return one ^ two


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all ``documents`` to files and describe each from the files read
    back. Null and empty texts are the end id alone; repeated and null ids are
    documents like any other; other columns are ignored."""
    path = fresh_shared_path(spark, "token-files")
    write_tokens(read_table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, ids=False)
