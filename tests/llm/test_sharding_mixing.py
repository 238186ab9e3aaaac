import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from roadframe.llm import mixing, sharding


def test_shards_of_odd_rows(odd_docs):
    rows = sharding.assign_shards(odd_docs, sharding.even_tree(24)).collect()
    texts = Counter((r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 8)
                    for r in odd_docs.collect())
    assert Counter((r.doc_id, r.text_crc32, r["size"]) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_movement_stays_in_changed_subtrees(spark):
    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    tree = sharding.even_tree(24)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 2.0 if x.shard == 4 else 1.0) for x in tree]
    key = [ids["doc_id"]]
    rows = ids.select(sharding.shard_of(key, tree).alias("a"), sharding.shard_of(key, sharding.grown(tree)).alias("b"),
                      sharding.shard_of(key, heavier).alias("c")).collect()
    assert {r.b for r in rows if r.a != r.b} == {24}
    assert 120 < sum(r.a != r.b for r in rows) < 290  # 1 of 25
    # shard 4 is in region 0 (shards 0 to 5): nothing moves between other regions
    assert all(r.a == r.c or r.c < 6 for r in rows)
    sizes = Counter(r.a for r in rows)
    assert len(sizes) == 24 and max(sizes.values()) < 1.4 * 5000 / 24


def test_weights_are_met(spark):
    ids = spark.range(8000).withColumnRenamed("id", "doc_id")
    tree = [sharding.Leaf("r", "k", 0, 1.0), sharding.Leaf("r", "k", 1, 3.0), sharding.Leaf("s", "l", 2, 4.0),
            sharding.Leaf("s", "l", 3, 0.0)]
    got = Counter(r[0] for r in ids.select(sharding.shard_of([ids["doc_id"]], tree)).collect())
    assert set(got) == {0, 1, 2} and abs(got[0] - 1000) < 150 and abs(got[1] - 3000) < 200


def plain_shard(doc_id, tree):
    """The three draws with xxhash in plain Python."""
    def score(label, weight):
        seed = xxhash.xxh64_intdigest(label.encode(), 42)
        if doc_id is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed)
        return -math.log(((seed & ((1 << 53) - 1)) + 0.5) / (1 << 53)) / weight

    for level in ("region", "rack", "shard"):
        groups = defaultdict(float)
        for leaf in tree:
            if leaf.weight > 0:
                groups[getattr(leaf, level)] += leaf.weight
        best = min(groups, key=lambda g: score(f"{level} {g}", groups[g]))
        tree = [leaf for leaf in tree if getattr(leaf, level) == best]
    return tree[0].shard


def test_draws_equal_plain_python(spark):
    ids = [None, *range(-20, 400), 2 ** 62]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    uneven = [sharding.Leaf(x.region, x.rack, x.shard, 1.0 + x.shard % 4) for x in sharding.even_tree(11)]
    for tree in (sharding.tree_of(24), sharding.tree_of(27), uneven):
        got = {r[0]: r[1] for r in df.select("doc_id", sharding.shard_of([df["doc_id"]], tree)).collect()}
        assert got == {i: plain_shard(i, tree) for i in ids}


def test_count_decides_the_tree(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    key = [ids["doc_id"]]
    counts = range(24, 31)
    for n in counts:
        assert sharding.tree_of(n + 1) == sharding.grown(sharding.tree_of(n))
    rows = ids.select(*(sharding.shard_of(key, sharding.tree_of(n)).alias(f"s{n}") for n in counts)).collect()
    for n in counts[:-1]:
        moved = [r for r in rows if r[f"s{n}"] != r[f"s{n + 1}"]]
        assert {r[f"s{n + 1}"] for r in moved} == {n} and 60 < len(moved) < 300
    assert sharding.tree_of(24) == sharding.even_tree(24) and sharding.tree_of(5) == sharding.even_tree(5)


def test_no_shards(no_docs):
    assert sharding.assign_shards(no_docs, sharding.even_tree(3)).collect() == []


def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("which", ["odd", "table"])
def test_mix_meets_targets(odd_docs, table, which):
    docs = odd_docs if which == "odd" else table("documents")
    rows = mixing.plan_mix(docs).collect()
    words = Counter((r.doc_id, len(re.findall(mixing.WORD, r.text or "")), r.source) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.source) for r in rows) == words
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2 and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and sorted(r.positions) == list(r.positions)
    target = expected_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in sizes:
        # rows equal in id and text share a draw, so one group may go over
        assert abs(taken[s] - target[s]) <= max(1, largest[s])


def test_positions_follow_the_schedule(table):
    plan = mixing.plan_mix(table("documents", "0.01"))
    rows = mixing.training_order(plan).select("source", "position", "size", "slope", "target").collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    # half of the run: D(1/2) = 1/2 - slope / 4 of the target
    half = Counter()
    for r in rows:
        half[r.source] += r["size"] * (r.position <= 0.5)
    for r in {r.source: r for r in rows}.values():
        assert half[r.source] / r.target == pytest.approx(0.5 - r.slope / 4, abs=0.08)


@pytest.mark.parametrize("which", ["odd", "table"])
def test_places_are_the_training_order(odd_docs, table, which):
    docs = odd_docs if which == "odd" else table("documents")
    rows = mixing.plan_order(docs).collect()
    plain = lambda rows: Counter((r.row, r.doc_id, r["size"], r.source, tuple(r.positions)) for r in rows)
    assert plain(rows) == plain(mixing.plan_mix(docs).collect())
    copies = sorted((place, r.positions[i], r.draw, i, r.row) for r in rows for i, place in enumerate(r.places))
    assert [c[0] for c in copies] == list(range(sum(r.copies for r in rows)))
    assert [c[1:] for c in copies] == sorted(c[1:] for c in copies)
    order = mixing.training_order(mixing.plan_mix(docs)).select("place", "position", "draw", "copy", "row").collect()
    assert [tuple(r) for r in order] == copies


def test_query_returns_the_training_order(spark):
    rows = mixing.op4_mixing(spark, "/root/testdata/sf0.001").collect()
    places = sorted((place, position) for r in rows for place, position in zip(r.places, r.positions, strict=True))
    assert len(places) == sum(r.copies for r in rows) > 0
    assert [p[0] for p in places] == list(range(len(places)))
    assert [p[1] for p in places] == sorted(p[1] for p in places)


def test_mixed_documents_and_reruns(odd_docs, table):
    for docs in (odd_docs, table("documents")):
        plan = mixing.plan_mix(docs)
        again = mixing.plan_mix(docs.repartition(3))
        key = lambda rows: sorted((str(r.doc_id), r["size"], r.taken, [round(p, 9) for p in r.positions]) for r in rows)
        assert key(plan.collect()) == key(again.collect())
        mixed = mixing.mix_documents(docs)
        assert mixed.columns == docs.columns
        wanted = Counter()
        for r in plan.collect():
            wanted[r.doc_id] += r.copies
        assert Counter(r.doc_id for r in mixed.collect()) == +wanted


def test_mix_of_nothing(no_docs):
    assert mixing.plan_mix(no_docs).collect() == [] and mixing.mix_documents(no_docs).collect() == []
