from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import jaccard, shingle_set

from roadframe.llm import components, dedup, minhash
from roadframe.llm.words import Words


def brute_classes(docs, threshold=0.8):
    """Smallest id by row of the connected components of all similar pairs."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (docs[i][1] or "") == (docs[j][1] or "") or (sets[i] and jaccard(sets[i], sets[j]) >= threshold):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(docs[i][0], least[find(i)]) for i in range(len(docs))]


@pytest.mark.parametrize("which", ["odd", "table"])
def test_classes_equal_brute_force(odd_docs, table, which):
    docs = odd_docs if which == "odd" else table("documents")
    found = dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == Counter(
        brute_classes(docs.select("doc_id", "text").collect()))


def near_copies(n, seed=0, length=80, edits=2):
    """A base text and copies with a few changed words; chains of copies too."""
    random = np.random.default_rng(seed)
    base = [f"w{x}" for x in random.integers(0, 10 ** 6, length)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        own = rows[random.integers(0, i)][1].split() if i % 7 == 0 else list(base)
        for at in random.integers(0, len(own), random.integers(1, edits + 2)):
            own[at] = f"x{random.integers(0, 10 ** 6)}"
        rows.append((i, " ".join(own)))
    return rows


def test_large_group_of_near_copies(spark):
    rows = near_copies(400) + [(1000 + i, t) for i, t in near_copies(50, seed=1, length=30, edits=4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == Counter(brute_classes(rows))


def test_near_copies_with_repeated_passages(spark):
    """How often a text has a passage does not count, only that it has it."""
    random = np.random.default_rng(5)
    rows = []
    for i in range(40):
        words = [f"w{x}" for x in random.integers(0, 10 ** 6, 160)]
        share, times = ((160 // 3, 20), (40, 400))[i % 2]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:share] * times + words[share:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == Counter(brute_classes(rows))
    assert {r.class_id for r in found} == set(range(0, 80, 2))


def weighted_jaccard(a, b):
    weigh = lambda found: sum(len(set(x)) for x in found)
    return weigh(a & b) / weigh(a | b)


def test_shingles_weigh_their_distinct_words(spark, table):
    """Pairs near the threshold, by the weighted measure, are told apart."""
    random = np.random.default_rng(9)
    rows = []
    for i in range(60):
        words = [f"w{x}" for x in random.integers(0, 10 ** 6, 100)]
        filler = ["no"] * int(random.integers(5, 40))
        more = [f"v{x}" for x in random.integers(0, 10 ** 6, int(random.integers(10, 26)))]
        rows += [(2 * i, " ".join(words + filler)), (2 * i + 1, " ".join(words + more))]
    for given in (rows, [tuple(r) for r in table("documents").select("doc_id", "text").collect()]):
        found = {r.doc_id: r.class_id for r in dedup.near_duplicates(spark.createDataFrame(given, "doc_id long, text string")).collect()}
        sets = {i: shingle_set(t) for i, t in given}
        for i in sorted(sets):
            for j in [i - 1] if given is rows else sorted(sets):
                if j in sets and j < i and sets[i] and sets[j] and abs(weighted_jaccard(sets[i], sets[j]) - 0.8) > 0.004:
                    if weighted_jaccard(sets[i], sets[j]) >= 0.8:
                        assert found[i] == found[j]
                    elif given is rows:
                        assert found[i] != found[j]


def sliding(n, seed, step=8, length=100):
    """Texts that only resemble their neighbours in a row of windows over one long text."""
    words = [f"c{x}" for x in np.random.default_rng(seed).integers(0, 10 ** 6, length + n * step)]
    return [" ".join(words[i * step:i * step + length]) for i in range(n)]


def test_later_rounds_read_only_what_changed(spark, monkeypatch):
    """Rounds of step 4 used to label every bucket row again."""
    texts = [t for seed in range(3) for t in sliding(30, seed)]
    texts += [t for seed in range(100, 250) for _, t in near_copies(2, seed)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, keep = [], dedup.stored

    def spy(df, name):
        out = keep(df, name)
        sizes.append((name, out.count()))
        return out
    monkeypatch.setattr(dedup, "stored", spy)
    found = dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == Counter(brute_classes(rows))
    whole = dict(sizes)["centred"]
    labelled = [n for name, n in sizes if name == "known"]
    assert [name for name, _ in sizes].count("new-links") >= 2
    assert labelled[0] == whole and sum(labelled[1:]) < whole


def test_texts_of_one_number_stay_apart(spark, monkeypatch):
    """Texts whose 64-bit numbers fall together are told apart by the longer hash."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(dedup, "text_node", lambda text: F.pmod(F.xxhash64(text), F.lit(5)))
    rows = near_copies(20) + [(100 + i, f"all of this text is number {i} and no other {i * i}") for i in range(30)]
    rows += [(200 + i, t) for i, t in rows[:10]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.class_id) for r in dedup.near_duplicates(docs).collect()) == Counter(brute_classes(rows))
    kept = {r.doc_id for r in dedup.keep_one(docs).collect()}
    assert kept == {c for _, c in brute_classes(rows)}


def test_keep_one(odd_docs, spark):
    kept = dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    wanted = {c for _, c in brute_classes(odd_docs.select("doc_id", "text").collect())}
    assert ids == Counter(wanted)
    twins = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert dedup.keep_one(twins).count() == 1


def test_no_documents(no_docs):
    assert dedup.near_duplicates(no_docs).collect() == [] and dedup.keep_one(no_docs).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_signatures_estimate_probability_jaccard():
    random = np.random.default_rng(1)
    owner = np.repeat([0, 1], 60)
    value = np.concatenate((np.arange(60), np.arange(20, 80))).astype(np.uint64) * np.uint64(977)
    weight = random.integers(1, 6, 80).astype(float)[np.concatenate((np.arange(60), np.arange(20, 80)))]
    registers = minhash.signatures(2, owner, value, weight, registers=4000)
    x, y = np.zeros(80), np.zeros(80)
    x[:60], y[20:] = weight[:60], weight[60:]
    shared = (x > 0) & (y > 0)
    exact = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(shared))
    assert (registers[0] == registers[1]).mean() == pytest.approx(exact, abs=0.04)


def test_shingles_are_those_of_the_text():
    texts = ["a b c d e f", "a  b\nc", "", None, "A b c d e f a b c d e"]
    owner, value, weight = minhash.shingles(Words(pa.array(texts), lower=True))
    assert np.bincount(owner, minlength=5).tolist() == [2, 1, 0, 0, 6]
    sets = [set(value[owner == i].tolist()) for i in range(5)]
    assert len(sets[0] & sets[4]) == 2 and not sets[1] & sets[0]
    assert weight.max() == pytest.approx(1 + np.log(2))
