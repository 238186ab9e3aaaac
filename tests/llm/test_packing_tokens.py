import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from roadframe.llm import coding, packing, rans, tokens
from roadframe.session import fresh_shared_path


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda text, end: [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB ÀßéŁΣσς\n\t 's<|endoftext|>12½–.,#漢́ \x1c"), max_size=60))
def test_chunked_ids_are_the_librarys(text):
    known = tokens.encoder()
    assert list(np.frombuffer(known.encode(text), known.dtype)) == known.tokenizer.encode(
        text, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=300))
def test_plan_uses_every_length_once(lengths):
    counts = np.bincount(lengths, minlength=41)
    bins = packing.plan_bins(counts, 40)
    used = np.zeros(41, int)
    for times, held in bins:
        assert times > 0 and sum(held) <= 40
        for x in held:
            used[x] += times
    assert (used == counts).all()
    # never more than a plain best fit could need
    assert sum(t for t, _ in bins) <= max(1, 2 * -(-sum(lengths) // 40))


def test_exact_complements_fill_bins():
    counts = np.zeros(101, int)
    for x in (100, 60, 40, 50, 30, 20, 55, 25, 10, 10):
        counts[x] += 1000
    bins = packing.plan_bins(counts, 100)
    assert sum(t for t, _ in bins) == 4000 and all(sum(h) == 100 for _, h in bins)


def check_packing(rows, docs, plain, capacity):
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for held in sequences.values():
        place = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= capacity
    wanted = defaultdict(list)
    for doc_id, text in docs:
        ids = np.array(plain(text, 1), "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            wanted[doc_id].append((piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {d: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in held) for d, held in by_doc.items()} == {
        d: sorted(held) for d, held in wanted.items()}
    return len(sequences)


def test_packing_of_odd_rows(odd_docs, plain):
    rows = packing.pack(odd_docs).collect()
    check_packing(rows, odd_docs.select("doc_id", "text").collect(), plain, 4096)


def test_packing_of_the_table(table, plain):
    docs = table("documents")
    rows = packing.pack(docs, capacity=512).collect()
    n = check_packing(rows, docs.select("doc_id", "text").collect(), plain, 512)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 512)  # near the lower bound


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=2000), st.integers(1, 64))
def test_rans_round_trip(values, lanes):
    values = np.array(values, np.int64)
    symbols, counts = np.unique(np.append(values, 7), return_counts=True)
    table = rans.Table.from_counts(symbols, counts)
    assert table.frequency.sum() == 1 << rans.SCALE_BITS
    assert (rans.decode(rans.encode(values, table, lanes), table) == values).all()


def test_rans_checkpoints_and_checksum():
    values = np.random.default_rng(0).integers(0, 50, 3000) ** 2
    table = rans.Table.from_counts(*np.unique(values, return_counts=True))
    block = rans.encode(values, table, lanes=4)
    parts = [rans.decode(block, table, k, k + 1) for k in range(3)]
    assert (np.concatenate(parts) == values).all() and len(parts[0]) == 4 * rans.CHECKPOINT_ROWS
    with pytest.raises(ValueError):
        rans.decode(block[:50] + bytes([block[50] ^ 1]) + block[51:], table)


def check_files(spark, docs, plain, **options):
    path = fresh_shared_path(spark, "test-token-files")
    coding.write_tokens(docs, path, **options)
    rows = sorted(coding.read_tokens(spark, path).collect(), key=lambda r: r.start)
    texts = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in rows] == [r.doc_id for r in texts]
    place, left = 0, defaultdict(list)
    for r in texts:
        left[r.doc_id].append(plain(r.text, 2))
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(ids), zlib.crc32(r.ids))
        left[r.doc_id].remove(ids)
        place += len(ids)
    assert not any(left.values())


def test_token_files_round_trip(spark, odd_docs, table, plain):
    check_files(spark, odd_docs, plain, block_tokens=100)
    check_files(spark, table("documents"), plain)


def test_rans_parts_decode_alone():
    values = np.random.default_rng(1).integers(0, 90, 5000) ** 2
    table = rans.Table.from_counts(*np.unique(values, return_counts=True))
    for n, lanes, every, tokens in ((5000, 4, 16, 100), (5000, 7, 3, 1), (4999, 64, 8, 512), (1, 4, 16, 9), (40, 64, 2, 5)):
        found = rans.parts(rans.encode(values[:n], table, lanes, every), tokens)
        decoded = [rans.decode(part, table) for _, part in found]
        assert (np.concatenate(decoded) == values[:n]).all()
        assert [p for p, _ in found] == np.cumsum([0, *map(len, decoded)])[:-1].tolist()
    assert len(rans.parts(rans.encode(values, table, 4, 16), 100)) == -(-5000 // 64)


def test_joined_checksums():
    text = bytes(range(256)) * 20
    for cut in (0, 1, 3, 255, 4000, len(text)):
        a, b = text[:cut], text[cut:]
        assert coding.joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(text)


def test_long_text_is_decoded_by_several_tasks(spark, plain):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    docs = spark.createDataFrame([(1, "short"), (2, long), (3, "x y"), (4, long + " tail"), (5, None)], "doc_id long, text string")
    path = fresh_shared_path(spark, "test-long-token-files")
    coding.write_tokens(docs, path, block_tokens=1000)
    whole = {r.doc_id: r for r in coding.read_tokens(spark, path).collect()}
    for ids in (True, False):
        cut = {r.doc_id: r for r in coding.read_tokens(spark, path, ids, long_block=1000).collect()}
        assert cut.keys() == whole.keys()
        for i, r in cut.items():
            assert all(r[c] == whole[i][c] for c in r.asDict())
    assert np.frombuffer(whole[2].ids, "<u4").tolist() == plain(long, 2)
    blocks = spark.read.parquet(f"{path}/blocks").where("tokens > 1000").select("part", "before", "doc_ids", "lengths", "block")
    parts = coding.cut_blocks(blocks, 250).repartition(4, "part", "before", "place")
    tasks = parts.withColumn("task", F.spark_partition_id()).groupBy("part", "before").agg(
        F.count_distinct("task").alias("tasks"), F.count(F.lit(1)).alias("n")).collect()
    assert len(tasks) == 2 and all(t.n > 2 and t.tasks > 1 for t in tasks)


def test_token_files_of_nothing(spark, no_docs):
    path = fresh_shared_path(spark, "test-no-token-files")
    coding.write_tokens(no_docs, path)
    assert coding.read_tokens(spark, path).collect() == []
