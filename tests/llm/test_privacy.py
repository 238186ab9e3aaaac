"""Personal data: patterns against plain regular expressions, the field
against enumeration, spans on hand-made and provided texts."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from roadframe.llm import privacy as P

PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def plain_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(PLAIN):
        for m in pattern.finditer(text):
            number = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if name == "card" and not (16 <= len(number) <= 19 and sum(
                    sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0):
                continue
            if name == "phone" and not 8 <= len(number) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


@pytest.fixture(scope="module")
def crf(table):
    texts = [r[0] for r in table("documents", "0.01").select("text").collect() if r[0]]
    return P.fit([P.document(t) for t in texts])


def test_patterns_equal_plain_regular_expressions(table):
    random.seed(1)
    pieces = ["a", "b.c", "@", ".", "%", "+", "-", " ", "(", ")", "1", "25", "300", "4111111111111111", "é", "٣", "\n",
              "x@y.z", "1.2.3.4", "+1 (555) 123-4567", "..", "007"]
    made = ["".join(random.choice(pieces) for _ in range(random.randrange(1, 25))) for _ in range(4000)]
    given = [r[0] or "" for r in table("documents", "0.01").select("text").collect()]
    for text in made + given:
        assert P.pattern_spans(text) == plain_spans(text), text


def test_patterns_take_linear_time():
    for text in ("a" * 300000 + "@", "1" * 300000, "1." * 150000, "+1" + "(" * 300000, "@" * 200000, "a@a-" * 75000):
        P.spans_of([text], P.fit([]))


def test_messages_equal_enumeration_without_loops():
    random_numbers = np.random.default_rng(3)
    field = P.Field(random_numbers.normal(0, 1, (P.DIMENSION, P.LABELS)), random_numbers.normal(0, 1, (P.LABELS,) * 2),
                    np.array([1.5, 0.7]))
    d = P.Document(spans=[(0, 1)] * 4, inputs=[[1, 2], [3], [4, 5], [6]], label=[0, 0, 0, 3],
                   edges=[(0, 1, P.CHAIN), (1, 2, P.EQUAL), (1, 3, P.SIMILAR)])
    tables, total = field.edge_tables(), np.zeros((4, P.LABELS))
    for labels in itertools.product(range(P.LABELS), repeat=4):
        if labels[3] != 3:
            continue
        score = sum(field.unary[d.inputs[i], labels[i]].sum() for i in range(3))
        score += sum(tables[t][labels[a], labels[b]] for a, b, t in d.edges)
        for i, v in enumerate(labels):
            total[i, v] += np.exp(score)
    expected = total / total.sum(axis=1, keepdims=True)
    found = field.beliefs([P.Document(), d, P.Document()])
    assert np.allclose(found, expected, atol=1e-4)


def test_field_adds_what_the_patterns_miss(crf):
    # the phone and the card run into one number, which both patterns drop
    text = "call +1 (269) 555-3296 4524132264652876 and go"
    assert plain_spans(text) == []
    assert [(x["kind"], text[x["start"]:x["end"]]) for x in P.spans_of([text], crf)[0]] == [
        ("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    # a number like one that a pattern found, far off, in another writing
    text = "call +1 (743) 555-3824 now. " + "some more words " * 300 + "or 743-555-3824 later"
    spans = P.spans_of([text], crf)[0]
    assert [(text[x["start"]:x["end"]], x["pattern"]) for x in spans] == [("+1 (743) 555-3824", True), ("743-555-3824", False)]
    alone = "some words or 743-555-3824 later"
    assert P.spans_of([alone], crf) == [[]]


def test_field_leaves_clean_texts_alone(crf):
    clean = ["", "plain words only", "pages 12-13, section 1.2.3 of 2024-01-02", "version 10.0.0.300", "a@b and @home",
             'token = "82d62c12f8e0439cbf46d53487d9d9af"', "1 2 3 4 5 6 7 8 9 10 11 12", "x = 3.14159265358979"]
    assert P.spans_of(clean, crf) == [[]] * len(clean)


def test_long_text_of_repeats(crf):
    text = "mail joe.1@mail.example.com or 743-555-3824; " * 20000
    spans = P.spans_of([text], crf)[0]
    assert sum(x["kind"] == "email" for x in spans) == 20000


def test_odd_rows(odd_docs, no_docs, crf):
    found = P.find_private(odd_docs, crf)
    assert found.columns == [*odd_docs.columns, "private_spans"]
    assert found.count() == odd_docs.count()
    assert P.find_private(no_docs, crf).count() == 0
    assert P.fit_sample(no_docs).beliefs([P.document("+1 (743) 555-3824")]).shape == (3, P.LABELS)


def test_redact(spark, crf):
    rows = [(1, "é to joe.1@mail.example.com, +1 (743) 555-3824.", 5), (2, None, 6), (3, "none", 7)]
    out = P.redact(spark.createDataFrame(rows, "doc_id long, text string, private int"), crf).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["é to [private], [private].", None, "none"]


def test_query(spark, table, sf_dir):
    rows = P.op12_private(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r["doc_id"]] or "")
        named = [f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(k == P.KINDS[x[0]] for x in base) for k in P.KINDS]
        assert set(named) <= set(filter(None, r["spans"].split(",")))
