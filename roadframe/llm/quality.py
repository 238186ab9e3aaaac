"""Quality classifier: a factorisation machine over hashed words and
structure statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package
from roadframe.llm.words import Words, release, slices

#: at most this many labelled rows, lowest hashes first, are fitted on
FIT_ROWS = 3000
BUCKETS = 1 << 11
RANK = 6
#: quantile bins of every statistic
BINS = 8
STATISTICS = 16


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text mod 3 is 1.
    A null id is not held out (it has no label either)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Features:
    """Statistics (dense) and word shares (document, bucket, share), sorted."""

    statistics: np.ndarray
    document: np.ndarray
    bucket: np.ndarray
    share: np.ndarray


def features(texts: pa.Array) -> Features:
    """Inputs of the classifier, from the text alone. Null is as empty: all zero."""
    words = Words(texts)
    n, counts, owner, code = len(texts), words.counts, words.owner, words.code
    size = np.maximum(counts, 1).astype(np.float64)
    unique = words.unique
    length = pc.utf8_length(unique).to_numpy(zero_copy_only=False)
    matches = lambda pattern: pc.match_substring_regex(unique, pattern).to_numpy(zero_copy_only=False)
    per_word = np.stack([
        length.astype(np.float64),
        matches(r"^\p{L}+[.,]?$"),  # plain words
        matches(r"[^\p{L}\p{N}.,]"),  # words with symbols
        matches(r"^[^\p{L}\p{N}]+$"),  # symbols only
        matches(r"\p{Lu}.*\p{Lu}") & ~matches(r"\p{Ll}"),  # shouted
        matches(r"\p{N}"),
        matches(r"^\p{Lu}"),
        matches(r"[.,]$"),
        length <= 3,
        length >= 12,
    ]).astype(np.float64)
    shares = [np.bincount(owner, row[code], n) / size for row in per_word]
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
    pairs, repeats = np.unique(owner * len(unique) + code, return_counts=True)
    pair_owner = pairs // max(len(unique), 1)
    most = np.zeros(n)
    np.maximum.at(most, pair_owner, repeats)
    filled = pc.fill_null(texts, "")
    lines = pc.count_substring(filled, "\n").to_numpy(zero_copy_only=False) + 1.0
    symbols = pc.count_substring_regex(filled, r"[^\p{L}\p{N}\s.,]").to_numpy(zero_copy_only=False)
    characters = np.maximum(pc.utf8_length(filled).to_numpy(zero_copy_only=False), 1)
    statistics = np.stack([
        *shares, np.bincount(owner, same, n) / size, np.bincount(pair_owner, minlength=n) / size, most / size,
        symbols / characters, np.log1p(counts), np.log1p(counts / lines)], axis=1)
    buckets = words.hashes() % np.uint64(BUCKETS)
    keys, times = np.unique(owner * BUCKETS + buckets.astype(np.int64)[code], return_counts=True)
    document = keys // BUCKETS
    return Features(statistics, document, keys % BUCKETS, times / size[document])


@dataclass
class Machine:
    """score = sigmoid(bias + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, x: Features) -> np.ndarray:
        """Linear in the non-zero inputs, by the sum-of-squares identity."""
        n = len(x.statistics)
        linear, sums, squares = np.full(n, self.bias), np.zeros((n, RANK)), np.zeros((n, RANK))
        rows, columns, values = _inputs(x, self.edges)
        linear += np.bincount(rows, self.weights[columns] * values, n)
        for f in range(RANK):
            part = self.factors[columns, f] * values
            sums[:, f] = np.bincount(rows, part, n)
            squares[:, f] = np.bincount(rows, part * part, n)
        z = linear + 0.5 * (sums * sums - squares).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _inputs(x: Features, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse inputs: word shares (root-scaled), then one bin per statistic."""
    n = len(x.statistics)
    bins = np.stack([np.searchsorted(edges[s], x.statistics[:, s], side="left") for s in range(STATISTICS)], axis=1)
    place = BUCKETS + np.arange(STATISTICS) * BINS + bins
    return (np.concatenate((x.document, np.repeat(np.arange(n), STATISTICS))),
            np.concatenate((x.bucket, place.ravel())),
            np.concatenate((np.sqrt(x.share), np.ones(n * STATISTICS))))


def fit(x: Features, label: np.ndarray, steps: int = 250, rate: float = 0.05, decay: float = 2e-4,
        seed: int = 0) -> Machine:
    """Adam on the mean log loss of a bounded sample. Without both labels the
    machine answers their share (0.5 without rows) for every text."""
    n, inputs = len(label), BUCKETS + STATISTICS * BINS
    shape = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(x.statistics, shape, axis=0).T if n else np.zeros((STATISTICS, BINS - 1))
    share = label.mean() if n else 0.5
    if not 0 < share < 1:
        return Machine(edges, 40.0 * (2.0 * share - 1.0), np.zeros(inputs), np.zeros((inputs, RANK)))
    rows, columns, values = _inputs(x, edges)
    dense = np.zeros((n, inputs), np.float32)
    dense[rows, columns] = values
    square = dense * dense
    random = np.random.default_rng(seed)
    theta = np.concatenate((np.zeros((inputs, 1)), random.normal(0, 0.02, (inputs, RANK))), axis=1).astype(np.float32)
    bias = float(np.log(share / (1 - share)))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, v = theta[:, 0], theta[:, 1:]
        sums = dense @ v
        z = bias + dense @ w + 0.5 * (sums * sums - square @ (v * v)).sum(axis=1)
        error = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) / n).astype(np.float32)
        grad = np.empty_like(theta)
        grad[:, 0] = error @ dense
        grad[:, 1:] = dense.T @ (error[:, None] * sums) - v * (error @ square)[:, None]
        grad += decay * theta
        bias -= rate * float(error.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Machine(edges, bias, theta[:, 0].astype(np.float64), theta[:, 1:].astype(np.float64))


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled documents, by lowest hash of the id.

    Only labels that are not held out are read; rows with a null id or label
    are left out, and of conflicting labels of one id the lower counts. The
    sample's ids, a bounded number, are broadcast to the documents; repeated
    documents of one id count once.
    """
    ship_package(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, label double, statistics array<double>, bucket array<int>, share array<float>"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                x = features(batch.column(1))
                cuts = np.searchsorted(x.document, np.arange(len(batch) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(list(x.statistics), pa.list_(pa.float64())),
                     pa.ListArray.from_arrays(cuts, pa.array(x.bucket, pa.int32())),
                     pa.ListArray.from_arrays(cuts, pa.array(x.share, pa.float32()))],
                    names=["doc_id", "label", "statistics", "bucket", "share"])

    rows_in = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "_label").mapInArrow(extract, schema)
    found = rows_in.dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow().combine_chunks()  # at most `rows`
    if not found.num_rows:
        return fit(Features(np.zeros((0, STATISTICS)), *(np.zeros(0, np.int64),) * 2, np.zeros(0)), np.zeros(0))
    flat = lambda name: found.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(found.column("bucket")).to_numpy()
    x = Features(flat("statistics").reshape(-1, STATISTICS), np.repeat(np.arange(found.num_rows), sizes),
                 flat("bucket").astype(np.int64), flat("share").astype(np.float64))
    return fit(x, found.column("label").to_numpy().astype(np.float32))


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and ``quality_score`` (double, 0 to 1): one
    narrow pass over whole texts, null as empty; only texts go to Python."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(machine)  # BUCKETS + STATISTICS * BINS rows of RANK + 1 numbers

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        found = [held.value.score(features(part.column(0))) for part in slices(batch, 0)]
        release()
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn("quality_score", score(F.col("text")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, columns as given."""
    scored = score_documents(docs, fit_sample(docs, labels))
    return scored.where(F.col("quality_score") >= threshold).select(*docs.columns)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score; see ``fit_sample`` and
    ``score_documents``."""
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = score_documents(docs.select("doc_id", "text"), fit_sample(docs, labels)).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
