"""Conversation trie against a plain Python trie, and its parts."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from roadframe.llm import dialogues as D


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in turns.items():
        cut = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = turns.get(base, [])[:cut] + mine[cut:]
    return out


def brute(rows):
    paths = rebuilt(rows)
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = set()

    def below(node):
        stack = [node]
        while stack:
            n = stack.pop()
            yield n
            stack += children[n]

    for node, who in members.items():
        under = list(below(node))
        ends = ",".join(map(str, sorted(c for c in who if len(paths[c]) == len(node))))
        out.add((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]),
                 sum(not children[n] for n in under), sum((len(members[n]) - 1) * len(n[-1][1]) for n in under if n),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth int, place string"


def nodes(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = D.prefix_trie(*D.rebuild(df)).collect()
    assert len(found) == len({tuple(r[c] for c in COLUMNS) for r in found})
    return {tuple(r[c] for c in COLUMNS) for r in found}


def test_trie_equals_brute_force(spark):
    random.seed(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, 206, -3, -100, -107, 300, 301]:
        for t in range(random.randrange(1, 9)):
            rows.append((c, random.choice([t, t, t, None, 2]), random.choice(["user", "assistant", None]),
                         random.choice(["hi", "hello", "", None, "ünï \U0001f642"])))
    rows += [(400, t, "user", f"turn {t % 3}") for t in range(45)]  # several blocks
    rows += [(c, t, "user", f"turn {t % 3}") for c in (401, 402) for t in range(45 if c == 401 else 20)]
    rows += [(None, 0, "user", "lost"), (7, 1, "user", "hi"), (7, 1, "user", "hi")]
    assert nodes(spark, rows) == brute(rows)


def test_common_conversation_and_first_turn(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(3000) for t in range(4)]
    rows += [(c, t, "user", "t0" if t == 0 else f"own {c} {t}") for c in range(3000, 3400) for t in range(3)]
    assert nodes(spark, rows) == brute(rows)


def test_hot_conversation_is_split(spark):
    """Running sums of one group over all partitions equal plain ones."""
    df = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("g"),
                                           "id", (F.col("id") % 11).alias("s"), F.xxhash64("id").alias("x"))
    out = D.running(df, "g", [F.col("id")], "running-test", sums=["s"], xors=["x"]).collect()
    plain = defaultdict(lambda: [0, 0, 0])
    expected = {}
    for r in sorted(df.collect(), key=lambda r: r["id"]):
        held = plain[r["g"]]
        plain[r["g"]] = [held[0] + 1, held[1] + r["s"], held[2] ^ r["x"]]
        expected[r["id"]] = plain[r["g"]]
    assert {r["id"]: [r["place"], r["s_to"], r["x_to"]] for r in out} == expected
    sizes = df.repartitionByRange(4, "g", "id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 2000  # the group of 2,667 rows lies in several partitions


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "only") for c in range(501, 540)]  # no base: a cut removes the one turn
    found = nodes(spark, rows)
    assert found == brute(rows)
    assert nodes(spark, [(None, 0, "user", "x")]) == set()
    assert nodes(spark, []) == set()
