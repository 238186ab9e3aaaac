"""Personal data in texts: exact patterns, and a skip-chain conditional random
field that labels what the patterns miss.

The field's nodes are atoms: tokens with a digit or an at sign (all other words
count as observed outsiders, which cuts the chain). Neighbours share transition
potentials; repeated or similar atoms anywhere in a document share skip
potentials, each linked to the next one like it. Atoms inside pattern spans are
observed. Sum-product message passing on this loopy graph then carries their
labels to the others.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package
from roadframe.llm.words import release, slices

KINDS = ("email", "ip", "card", "phone")
#: labels of atoms: outside, then begin and inside of each kind
LABELS = 1 + 2 * len(KINDS)
KIND_OF = np.array([0, *(k + 1 for k in range(len(KINDS)) for _ in (0, 1))])
#: the field is fitted on the atoms of at most this many documents, lowest
#: hashes first, and of those with at most FIT_ATOMS atoms
FIT_DOCS = 3000
FIT_ATOMS = 400
DIMENSION = 1 << 11
ROUNDS = 20
#: least probability of a kind for a span beside the patterns
SURE = 0.8
#: edges: neighbours, equal atoms, similar atoms
CHAIN, EQUAL, SIMILAR = range(3)
#: weight of agreement over a skip edge before the data speak: few documents of a
#: sample repeat an entity, and one that does all but settles the label
AGREE = 8.0
CLAMP = 40.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# what fails at the start of a run of digits fails inside it as well
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ATOM = _LOCAL + "@()"
_MARK = re.compile(r"[0-9@]")
_REST = re.compile(r"[A-Za-z0-9._%+@()-]+")
_NEIGHBOUR = re.compile(r"[\x20\t]{1,2}\Z|[\x20\t]?-[\x20\t]?\Z")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        digit = (ord(c) - 48) * (1 + i % 2)
        total += digit - 9 * (digit > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every pattern match that holds, by kind and start.
    Every pattern goes through the text once, in linear time."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:
        local = text[done:at]
        start = done + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append((0, start, domain.end()))
        done = domain.end() if domain else at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            number = digits_of(m.group())
            if 16 <= len(number) <= 19 and luhn(number):
                found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m.group())) <= 15:
                found.append((3, *m.span()))
    return found


def atoms(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign, without the punctuation around them."""
    out, done = [], 0
    mark = _MARK.search(text)
    while mark:
        gap = text[done:mark.start()]
        start = done + len(gap.rstrip(_ATOM))
        done = _REST.match(text, mark.start()).end()
        token = text[start:done]
        left = len(token) - len(token.lstrip("._%-)"))
        token = token.strip("._%-").lstrip(")").rstrip("+(")
        if token.startswith("(") and ")" not in token:
            token, left = token[1:], left + 1
        if token.endswith(")") and "(" not in token:
            token = token[:-1]
        if token:
            out.append((start + left, start + left + len(token)))
        mark = _MARK.search(text, done)
    return out


def _shape(token: str) -> tuple[str, str]:
    """Digit runs as their lengths, letter runs as ``a``; and the same without lengths."""
    long = re.sub(r"[A-Za-z]+", "a", token)
    return re.sub(r"[0-9]+", lambda m: f"<{min(m.end() - m.start(), 20)}>", long), re.sub(r"[0-9]+", "9", long)


@dataclass
class Document:
    """Atoms of one text with their inputs, observed labels and edges."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    base: list[tuple[int, int, int]] = field(default_factory=list)
    inputs: list[list[int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    edges: list[tuple[int, int, int]] = field(default_factory=list)


def document(text: str) -> Document:
    """Graph of a text: linear in its atoms, whatever they repeat."""
    out = Document(base=pattern_spans(text))
    out.spans = atoms(text)
    tokens = [text[a:b] for a, b in out.spans]
    shapes = [_shape(t[:64]) for t in tokens]
    owner = _owners(out.spans, out.base)
    joined = [False] * len(tokens)
    for i in range(1, len(tokens)):
        between = text[out.spans[i - 1][1]:out.spans[i][0]]
        joined[i] = len(between) <= 3 and bool(_NEIGHBOUR.match(between))
        if joined[i]:
            out.edges.append((i - 1, i, CHAIN))
    last: dict[tuple[int, str], int] = {}
    for i, token in enumerate(tokens):
        a, b = out.spans[i]
        number = digits_of(token)
        long, short = shapes[i]
        names = ["bias", f"l{long}", f"s{short}", f"n{min(len(number), 20)}",
                 f"b{text[a - 1:a]}", f"a{text[b:b + 1]}",
                 f"p{shapes[i - 1][0] if joined[i] else ''}", f"f{shapes[i + 1][0] if i + 1 < len(tokens) and joined[i + 1] else ''}"]
        if 13 <= len(number) <= 19:
            names.append(f"luhn{luhn(number)}")
        if short == "9.9.9.9":
            names.append(f"octets{all(map(_small, token.split('.')))}")
        out.inputs.append([zlib.crc32(n.encode("utf-8", "replace")) % DIMENSION for n in names])
        span = owner[i]
        first = span >= 0 and (i == 0 or owner[i - 1] != span)
        out.label.append(0 if span < 0 else 1 + 2 * out.base[span][0] + (not first))
        keys = [(EQUAL, token.lower())] if len(number) >= 4 or "@" in token else []
        if len(number) >= 7:
            keys.append((SIMILAR, number[-7:]))
        if "@" in token:
            keys.append((SIMILAR, token.lower().split("@")[0]))
        linked = set()
        for key in keys:
            if key in last and last[key] not in linked:
                linked.add(last[key])
                out.edges.append((last[key], i, key[0]))
            last[key] = i
    return out


def _owners(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """The pattern span that overlaps each atom (the first kind's), else -1."""
    out = [-1] * len(spans)
    for kind in range(len(KINDS)):
        i = 0
        for k, (found, a, b) in enumerate(base):
            if found != kind:
                continue
            while i < len(spans) and spans[i][1] <= a:
                i += 1
            j = i
            while j < len(spans) and spans[j][0] < b:
                if out[j] < 0:
                    out[j] = k
                j += 1
    return out


@dataclass
class Field:
    """Potentials: per input and label, chain transitions, agreement by skip edge."""

    unary: np.ndarray
    chain: np.ndarray
    agree: np.ndarray

    def edge_tables(self) -> np.ndarray:
        same = ((KIND_OF[:, None] == KIND_OF[None, :]) & (KIND_OF[:, None] > 0)).astype(float)
        return np.stack([self.chain, self.agree[0] * same, self.agree[1] * same])

    def beliefs(self, docs: list[Document]) -> np.ndarray:
        """Probabilities of the labels of all atoms, by ``ROUNDS`` rounds of
        damped sum-product messages over all edges at once."""
        sizes = [len(d.spans) for d in docs]
        shift = np.cumsum([0, *sizes])
        n = int(shift[-1])
        node = np.repeat(np.arange(n), [len(x) for d in docs for x in d.inputs])
        inputs = np.array([v for d in docs for x in d.inputs for v in x], np.int64)
        label = np.array([v for d in docs for v in d.label], np.int64)
        scores = np.stack([np.bincount(node, self.unary[inputs, k], n) for k in range(LABELS)], axis=1)
        observed = label > 0
        scores[observed] = -CLAMP
        scores[observed, label[observed]] = 0.0
        edges = np.array([(a + s, b + s, t) for d, s in zip(docs, shift) for a, b, t in d.edges], np.int64).reshape(-1, 3)
        if len(edges):
            tables = self.edge_tables()
            # every edge in both directions: message e goes from source to target
            source = np.concatenate((edges[:, 0], edges[:, 1]))
            target = np.concatenate((edges[:, 1], edges[:, 0]))
            kind = np.concatenate((edges[:, 2], edges[:, 2]))
            turned = np.repeat([False, True], len(edges))
            table = np.where(turned[:, None, None], tables[kind].transpose(0, 2, 1), tables[kind])
            back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
            messages = np.zeros((len(source), LABELS))
            for _ in range(ROUNDS):
                total = scores + _gather(target, messages, n)
                held = (total[source] - messages[back])[:, :, None] + table
                top = held.max(axis=1)
                new = top + np.log(np.exp(held - top[:, None, :]).sum(axis=1))
                messages = 0.5 * messages + 0.5 * (new - new.max(axis=1, keepdims=True))
            scores = scores + _gather(target, messages, n)
        scores = np.exp(scores - scores.max(axis=1, keepdims=True)) if n else scores
        return scores / scores.sum(axis=1, keepdims=True) if n else scores


def _gather(target: np.ndarray, messages: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(target, messages[:, k], n) for k in range(LABELS)], axis=1)


def _plausible(kind: int, text: str) -> bool:
    number = digits_of(text)
    if kind == 0:
        local, _, domain = text.partition("@")
        return bool(local) and "." in domain
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(p.isdecimal() and p.isascii() and _small(p) for p in parts)
    if kind == 2:
        return 13 <= len(number) <= 19 and luhn(number)
    return 7 <= len(number) <= 15 and len(text) <= 2 * len(number) + 4


def added_spans(text: str, found: Document, beliefs: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Runs of neighbouring atoms, outside the pattern spans, that the field
    gives one kind, and that look like it: (kind, start, end, probability)."""
    share = np.stack([beliefs[:, KIND_OF == k].sum(axis=1) for k in range(len(KINDS) + 1)], axis=1)
    label, best = beliefs.argmax(axis=1), share.argmax(axis=1)
    joined = {b for _, b, t in found.edges if t == CHAIN}
    runs: list[list] = []
    for i, (a, b) in enumerate(found.spans):
        kind = int(best[i]) - 1
        if found.label[i] or kind < 0 or share[i, kind + 1] < SURE:
            continue
        goes_on = label[i] > 0 and label[i] % 2 == 0  # an inside label
        if runs and runs[-1][0] == kind and runs[-1][4] == i - 1 and i in joined and goes_on:
            runs[-1][2], runs[-1][3], runs[-1][4] = b, min(runs[-1][3], float(share[i, kind + 1])), i
        else:
            runs.append([kind, a, b, float(share[i, kind + 1]), i])
    return [tuple(r[:4]) for r in runs if _plausible(r[0], text[r[1]:r[2]])]


def fit(docs: list[Document], steps: int = 200, rate: float = 0.1, decay: float = 0.02) -> Field:
    """Pseudo-likelihood of every atom's label given its inputs and its
    neighbours' labels, by Adam. Labels are those of the patterns; copies of
    numbers without their country code join in at half weight, so that the
    field does not rest on it. Without atoms everything stays outside."""
    graphs = [(d, 1.0) for d in docs] + [(d, 0.5) for d in map(_without_code, docs) if d is not None]
    label = np.array([v for d, _ in graphs for v in d.label], np.int64)
    n = len(label)
    unary, chain, agree = np.zeros((DIMENSION, LABELS)), np.zeros((LABELS, LABELS)), np.full(2, AGREE)
    if not n:
        unary[zlib.crc32(b"bias") % DIMENSION, 0] = 2 * CLAMP
        return Field(unary, chain, agree)
    weight = np.concatenate([np.full(len(d.label), w) for d, w in graphs]) / n
    shift = np.cumsum([0, *(len(d.label) for d, _ in graphs)])
    node = np.repeat(np.arange(n), [len(x) for d, _ in graphs for x in d.inputs])
    inputs = np.array([v for d, _ in graphs for x in d.inputs for v in x], np.int64)
    edges = np.array([(a + s, b + s, t) for (d, _), s in zip(graphs, shift) for a, b, t in d.edges], np.int64).reshape(-1, 3)
    links, skips = edges[edges[:, 2] == CHAIN], edges[edges[:, 2] != CHAIN]
    into = np.concatenate((skips[:, 1], skips[:, 0]))
    other = label[np.concatenate((skips[:, 0], skips[:, 1]))]
    kind = np.concatenate((skips[:, 2], skips[:, 2])) - EQUAL
    same = ((KIND_OF[None, :] == KIND_OF[other][:, None]) & (KIND_OF[None, :] > 0)).astype(float)
    truth = np.eye(LABELS)[label]
    theta = [unary, chain, agree]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    start = [np.zeros_like(unary), np.zeros_like(chain), np.full(2, AGREE)]
    for step in range(1, steps + 1):
        scores = np.stack([np.bincount(node, theta[0][inputs, k], n) for k in range(LABELS)], axis=1)
        np.add.at(scores, links[:, 1], theta[1][label[links[:, 0]]])
        np.add.at(scores, links[:, 0], theta[1][:, label[links[:, 1]]].T)
        np.add.at(scores, into, theta[2][kind][:, None] * same)
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        error = (scores / scores.sum(axis=1, keepdims=True) - truth) * weight[:, None]
        grads = [np.stack([np.bincount(inputs, error[node, k], DIMENSION) for k in range(LABELS)], axis=1),
                 np.zeros_like(chain), np.bincount(kind, (error[into] * same).sum(axis=1), 2)]
        np.add.at(grads[1], label[links[:, 0]], error[links[:, 1]])
        np.add.at(grads[1].T, label[links[:, 1]], error[links[:, 0]])
        for k in range(3):
            g = grads[k] + decay / n * (theta[k] - start[k])
            first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
            theta[k] = theta[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Field(*theta)


def _without_code(d: Document) -> Document | None:
    """``d`` without the first atom of every phone of several atoms."""
    phone = 1 + 2 * KINDS.index("phone")
    drop = {i for i in range(len(d.label) - 1) if d.label[i] == phone and d.label[i + 1] == phone + 1}
    if not drop:
        return None
    place, kept = {}, []
    for i in range(len(d.label)):
        if i not in drop:
            place[i] = len(kept)
            kept.append(i)
    names = zlib.crc32(b"p") % DIMENSION  # no neighbour before
    out = Document()
    for i in kept:
        after = i - 1 in drop
        # the seventh input is the shape of the neighbour before
        out.inputs.append([names if after and k == 6 else v for k, v in enumerate(d.inputs[i])])
        out.label.append(phone if after else d.label[i])
    out.edges = [(place[a], place[b], t) for a, b, t in d.edges if a not in drop and b not in drop]
    return out


def fit_sample(docs: DataFrame, most: int = FIT_DOCS) -> Field:
    """Fit on at most ``most`` documents that hold an atom, by lowest hash of
    the id; rows with a null id are left out, repeated ids count once."""
    ship_package(docs.sparkSession)
    marked = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = marked.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    schema = "doc_id long, inputs array<array<int>>, label array<int>, edges array<array<int>>"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                d = document(text)
                if len(d.label) <= FIT_ATOMS:
                    rows.append((doc_id, d.inputs, d.label, [list(e) for e in d.edges]))
            kinds = [pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                             names=["doc_id", "inputs", "label", "edges"])

    found = marked.join(F.broadcast(chosen), "doc_id").mapInArrow(extract, schema)  # `most` ids
    rows = found.dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow().to_pylist()  # at most `most` documents of FIT_ATOMS
    return fit([Document(inputs=r["inputs"], label=r["label"], edges=[tuple(e) for e in r["edges"]]) for r in rows])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.bool_()),
                             ("score", pa.float64())]))


def spans_of(texts: list[str], crf: Field) -> list[list[dict]]:
    """All spans of each text, by kind and start."""
    found = [document(t) for t in texts]
    beliefs = crf.beliefs(found)
    out, at = [], 0
    for text, d in zip(texts, found):
        mine, at = beliefs[at:at + len(d.spans)], at + len(d.spans)
        rows = [(k, a, b, True, 1.0) for k, a, b in d.base]
        if any(not v for v in d.label):
            rows += [(k, a, b, False, p) for k, a, b, p in added_spans(text, d, mine)]
        out.append([dict(zip(("kind", "start", "end", "pattern", "score"), (KINDS[r[0]], *r[1:]))) for r in sorted(rows)])
    return out


def find_private(docs: DataFrame, crf: Field) -> DataFrame:
    """All columns of ``docs`` and ``private_spans``: array of (kind, start,
    end, pattern, score), by kind as in ``KINDS`` and start; places are code
    points, the end is exclusive. Pattern spans are all kept; others do not
    overlap them. Null and empty texts have none. One narrow pass; only texts
    go to Python."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(crf)  # DIMENSION rows of LABELS numbers

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,pattern:boolean,score:double>>")
    def find(texts: pa.Array) -> pa.Array:
        parts = []
        for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
            column = part.column(0)
            marked = np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
                                    .to_numpy(zero_copy_only=False))
            rows: list[list[dict]] = [[] for _ in range(len(column))]
            for i, spans in zip(marked.tolist(), spans_of(column.take(pa.array(marked)).to_pylist(), held.value)):
                rows[i] = spans
            parts.append(pa.array(rows, _SPANS))
        release()
        return pa.concat_arrays(parts) if parts else pa.array([], _SPANS)

    return docs.withColumn("private_spans", find(F.col("text")))


def redact(docs: DataFrame, crf: Field, mark: str = "[private]") -> DataFrame:
    """``docs`` with every span of the texts replaced by ``mark``, columns as given."""
    found = find_private(docs, crf)
    ordered = F.array_sort("private_spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                           .otherwise(a["end"] - b["end"]))
    state = F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda s, x: F.when(
        x["end"] <= s["at"], s).otherwise(F.struct(F.concat(
            s["out"], F.substring(F.col("text"), s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))),
            F.when(x["start"] >= s["at"], F.lit(mark)).otherwise(F.lit(""))).alias("out"), x["end"].alias("at"))))
    text = F.when(F.size("private_spans") == 0, F.col("text")).otherwise(
        F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.char_length("text"))))
    return found.withColumn("text", text).select(*docs.columns)


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def op12_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document. Counts and ``base_sha256`` are of the pattern
    spans, ``spans`` holds all; see ``find_private``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_private(docs, fit_sample(docs)).select("doc_id", "private_spans")
    base = F.filter("private_spans", lambda x: x["pattern"])
    return found.select(
        "doc_id", *(_count(base, k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("private_spans")).alias("spans"))
