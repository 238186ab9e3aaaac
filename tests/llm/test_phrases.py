"""Phrase mining: tries against dictionaries, phrases against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from roadframe.llm import phrases as M
from roadframe.llm.tries import DoubleArray


def trie_of(keys):
    data = np.frombuffer(b"".join(keys), np.uint8)
    return DoubleArray(np.cumsum([0, *map(len, keys)]), data, np.arange(len(keys)))


def test_trie_equals_a_dictionary():
    random.seed(2)
    keys = list({bytes(random.randrange(256) if random.random() < .3 else random.choice(b"abc")
                       for _ in range(random.randrange(0, 9))) for _ in range(5000)} | {bytes([b]) for b in range(256)})
    known = {k: i for i, k in enumerate(keys)}
    trie = trie_of(keys)
    asked = keys + [bytes(random.choice(b"abcd") for _ in range(random.randrange(0, 12))) for _ in range(5000)]
    found = trie.look_up(np.cumsum([0, *map(len, asked)]), np.frombuffer(b"".join(asked), np.uint8))
    assert found.tolist() == [known.get(k, -1) for k in asked]
    assert trie_of([]).look_up(np.array([0, 1]), np.array([97], np.uint8)).tolist() == [-1]


def pieces_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def test_words_equal_a_plain_split():
    texts = ["A b\tC, d.\x0be", None, "", "  ", "Ünï cödé x y", "one", ".", "tail ", " head", "a\r\nb c!d"]
    words = M.PieceWords(pa.array(texts))
    spelled = [words.unique[c].as_py().decode() for c in words.code.tolist()]
    assert spelled == [w for t in texts for p in pieces_of(t) for w in p]
    expected = [i > 0 for t in texts for p in pieces_of(t) for i in range(len(p))]
    assert words.joined.tolist() == expected
    assert words.row.tolist() == [i for i, t in enumerate(texts) for p in pieces_of(t) for _ in p]


def brute(rows, support, longest, cover):
    totals, counts = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in pieces_of(text):
            totals[lang] += len(piece)
            for size in range(1, longest + 1):
                for i in range(len(piece) - size + 1):
                    counts[lang, tuple(piece[i:i + size])] += 1
    found = {k: v for k, v in counts.items() if v >= support}
    out = set()
    for (lang, words), a in found.items():
        n = len(words)
        if n < 2:
            continue
        score, cut = min((2000000 * a // (found[lang, words[:k]] + found[lang, words[k:]]), k) for k in range(1, n))
        if not any(l2 == lang and len(w2) > n and 100 * b >= cover * a
                   and any(w2[i:i + n] == words for i in range(len(w2) - n + 1)) for (l2, w2), b in found.items()):
            out.add((lang, " ".join(words), a, found[lang, words[:cut]], found[lang, words[cut:]], score, cut))
    return out, totals


def made_rows():
    random.seed(5)
    words = ["The", "cat", "sat", "on", "a", "mat", "é", "x-y"]
    rows = []
    for i in range(60):
        text = "".join(random.choice(words) + random.choice([" ", " ", " ", "\t", ". ", ",", "\n"]) for _ in range(random.randrange(0, 60)))
        rows.append((text, random.choice(["en", "de", None])))
    return rows + rows[:5] + [(None, "en"), ("", None), ("cat sat on a mat " * 400, "en"), ("one", "fr")]


def test_phrases_equal_brute_force(spark, monkeypatch):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "text string, lang string, rank int, word string")
    expected, totals = brute(rows, 6, 4, 80)
    assert expected

    def found():
        phrases, counted = M.mine(docs, support=6)
        assert {r["lang"]: r["total"] for r in counted.collect()} == dict(totals)
        return {(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["score"], r["cut"]) for r in phrases.collect()}

    assert found() == expected
    # many small tries give the same
    monkeypatch.setattr(M, "TRIE_BYTES", 40)
    monkeypatch.setattr(M, "TRIE_PHRASES", 7)
    assert found() == expected


def test_passes_do_not_grow_with_tries(spark, monkeypatch):
    """The texts are cut into words once, and a level reads its blocks once."""
    docs = spark.createDataFrame(made_rows(), "text string, lang string")
    names, stored = [], M.stored
    monkeypatch.setattr(M, "stored", lambda df, name, *a, **b: names.append(name) or stored(df, name, *a, **b))
    M.mine(docs, support=6)
    one, names[:] = list(names), []
    monkeypatch.setattr(M, "TRIE_BYTES", 40)
    monkeypatch.setattr(M, "TRIE_PHRASES", 7)
    M.mine(docs, support=6)
    assert len(names) == len(one)


def test_tries_are_opened_once_a_block(monkeypatch):
    """Every place is walked in one trie only; blocks cross the batches."""
    random.seed(3)
    tuples = sorted({(random.randrange(1, 300), random.randrange(1, 300)) for _ in range(4000)})
    shard = M.dealt(list(np.array(tuples).T), 5)
    assert np.bincount(shard, minlength=5).min() > 500
    walked = []

    class Held:
        def __init__(self, k):
            here = [i for i in range(len(tuples)) if shard[i] == k]
            data = np.array([[b for w in tuples[i] for b in (w >> 8, w & 255)] for i in here], np.uint8).ravel()
            self.value = DoubleArray(np.arange(len(here) + 1) * 4, data, np.array(here))
            walk = self.value.walk
            self.value.walk = lambda levels: walked.append(len(levels[0])) or walk(levels)

    ids = np.array([random.randrange(300) for _ in range(20000)], np.int32)
    known = {t: i + 1 for i, t in enumerate(tuples)}
    got = M.advance([Held(k) for k in range(5)], ids, 2, 2)
    pairs = list(zip(ids.tolist(), ids[1:].tolist()))
    assert got.tolist() == [known.get(p, 0) for p in pairs] + [0]
    assert len(walked) == 5 and sum(walked) == sum(a > 0 and b > 0 for a, b in pairs)
    monkeypatch.setattr(M, "BLOCK_IDS", 1000)
    batch = lambda part: pa.RecordBatch.from_arrays([M._rows(part)], names=["ids"])
    ids[::40] = 0
    blocks = list(M._blocks(map(batch, (ids[:400], ids[400:440], ids[440:9000], ids[9000:]))))
    assert np.concatenate(blocks).tolist() == ids.tolist() and len(blocks) < 30 and max(map(len, blocks)) <= 1200


def test_top_of_a_language(spark):
    rows = [("en", f"p{i:03d}", i % 7, 1 + i % 3) for i in range(300)]
    out = M.top(spark.createDataFrame(rows, "lang string, phrase string, score long, a long"), 20).orderBy("rank").collect()
    best = sorted(rows, key=lambda r: (-r[2], -r[3], r[1]))[:20]
    assert [(r["phrase"], r["rank"]) for r in out] == [(r[1], i + 1) for i, r in enumerate(best)]


def test_no_rows(no_docs):
    phrases, totals = M.mine(no_docs)
    assert phrases.count() == 0 and totals.count() == 0
