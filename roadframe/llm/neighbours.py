"""Approximate nearest neighbours by largest inner product: multiprobe
p-stable hashing with exact reranking.

Vectors are scaled by the largest norm and completed to unit length by one
more coordinate, so that the largest inner product with a unit query is the
smallest distance. A table hashes a vector by K Gaussian projections, each cut
into intervals of width ``WIDTH``. For a neighbour at similarity ``c`` the
projection given the query's is normal with mean ``c`` times the query's and
variance ``1 - c * c``; so every perturbed bucket has an estimated success
probability, and a query visits buckets from the likeliest on until they sum
up to the success wanted of a table. A query that would need more than
``MAX_PROBES`` of them, or that comes back with fewer rows than there are, is
compared with all vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package, stored

NEAREST = 20
TABLES = 4
WIDTH = 1.5
#: estimated probability that some table finds a neighbour
SUCCESS = 0.97
#: vectors that a bucket is meant to hold; gives the number of projections
OCCUPANCY = 64
#: vectors on which the similarity of neighbours is estimated
SAMPLE = 2000
#: bytes of vectors in one group of buckets
GROUP_BYTES = 16 << 20
MAX_PROBES = 1 << 16
#: bytes of interval combinations that are weighed at once
PROBE_BYTES = 64 << 20


@dataclass
class Index:
    """Parameters of all tables: the same for every task."""

    scale: float
    similarity: float
    directions: np.ndarray  # tables x (dimension + 1) x projections
    shifts: np.ndarray
    groups: int
    lead: int  # projections whose intervals decide a bucket's group

    @staticmethod
    def draw(dimension: int, rows: int, scale: float, similarity: float, groups: int, seed: int = 0) -> Index:
        bits = math.log2(math.sqrt(2 * math.pi * math.e) / WIDTH)
        k = max(3, round(math.log2(max(rows, 1) / OCCUPANCY + 1) / bits))
        random = np.random.default_rng(seed)
        return Index(scale, similarity, random.normal(size=(TABLES, dimension + 1, k)),
                     random.uniform(0, WIDTH, (TABLES, k)), groups, min(k, math.ceil(math.log2(max(groups, 1)) / bits)))

    def group(self, cells: np.ndarray) -> np.ndarray:
        """Group of a bucket: near buckets, of equal leading intervals, lie in
        one group, so that a query's likely buckets lie in few."""
        return _bucket(cells[..., :self.lead]) % self.groups

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Tables x rows x projections."""
        norms = np.linalg.norm(vectors, axis=1)
        unit = vectors / (norms if query else np.full(len(vectors), self.scale))[:, None]
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0.0, 1.0 - (norms / self.scale) ** 2))
        return np.concatenate((unit, rest[:, None]), axis=1) @ self.directions

    def buckets(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups and bucket numbers, tables x rows."""
        cells = np.floor((self.project(vectors, False) + self.shifts[:, None, :]) / WIDTH).astype(np.int64)
        return self.group(cells), _bucket(cells)

    def probes(self, vectors: np.ndarray, most: int = MAX_PROBES) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """By table and query: groups and bucket numbers in descending
        estimated success; none for a query that ``most`` buckets of some table
        do not suffice. PROBE_BYTES bound what is held at once, whatever the
        rows of the index."""
        wanted = 1.0 - (1.0 - SUCCESS) ** (1.0 / TABLES)
        spread = math.sqrt(1.0 - self.similarity ** 2)
        cells = np.arange(-math.ceil(6 / WIDTH) - 1, math.ceil(6 / WIDTH) + 1)
        none = (np.zeros(0, np.int64),) * 2
        found, short = [], np.zeros(len(vectors), bool)
        for table, projected in enumerate(self.project(vectors, True)):
            # chance of every interval of every projection
            edges = np.append(cells, cells[-1] + 1)[:, None] * WIDTH - self.shifts[table]
            z = (edges[None] - self.similarity * projected[:, None, :]) / spread
            chance = np.diff(_normal(z), axis=1)
            rows, open_, keep = [none] * len(vectors), np.flatnonzero(~short), min(256, most)
            while len(open_):
                # products, their order and the combinations chosen so far
                step = max(1, PROBE_BYTES // (keep * 8 * (3 * len(cells) + 2 * chance.shape[2])))
                left = []
                for i in range(0, len(open_), step):
                    some = open_[i:i + step]
                    score, chosen = _likeliest(chance[some], keep)
                    total = np.cumsum(score, axis=1)
                    for r, at in enumerate(some.tolist()):
                        if total[r, -1] >= wanted:
                            picked = cells[chosen[r, :1 + int((total[r] < wanted).sum())]]
                            rows[at] = (self.group(picked), _bucket(picked))
                        elif keep >= most or score.shape[1] < keep:
                            short[at] = True
                        else:
                            left.append(at)
                open_, keep = np.array(left, np.int64), min(4 * keep, most)
            found.append(rows)
        return [[none if cut else row for row, cut in zip(rows, short.tolist(), strict=True)] for rows in found]


def _normal(z: np.ndarray) -> np.ndarray:
    """Normal distribution function, to about 1e-7 (Abramowitz and Stegun 26.2.17)."""
    x = np.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * x)
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, 1.0 - tail, tail)


def _likeliest(chance: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` likeliest interval combinations of each query, likeliest
    first. Taking the projections one by one and keeping that many is exact,
    as a combination in the best ``keep`` has its beginning among the best."""
    n, cells, k = chance.shape
    score, chosen = np.ones((n, 1)), np.zeros((n, 1, 0), np.int64)
    rows = np.arange(n)[:, None]
    for d in range(k):
        total = (score[:, :, None] * chance[:, None, :, d]).reshape(n, -1)
        if total.shape[1] > keep:
            best = np.argpartition(-total, keep - 1, axis=1)[:, :keep]
        else:
            best = np.broadcast_to(np.arange(total.shape[1]), total.shape)
        score = total[rows, best]
        chosen = np.concatenate((chosen[rows, best // cells], (best % cells)[:, :, None]), axis=2)
    order = np.argsort(-score, axis=1, kind="stable")
    return score[rows, order], chosen[rows, order]


def _bucket(cells: np.ndarray) -> np.ndarray:
    """One number for a combination of intervals (last axis)."""
    with np.errstate(over="ignore"):
        number = np.zeros(cells.shape[:-1], np.uint64)
        for d in range(cells.shape[-1]):
            number = (number ^ (cells[..., d] + 1024).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            number ^= number >> np.uint64(32)
    return (number >> np.uint64(1)).astype(np.int64)


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def usable(vectors: DataFrame) -> DataFrame:
    """``id, vector``: rows with an id whose vector is not null or zero and
    holds no null or non-finite component. Rows repeated with one id count
    once (the smallest vector). Vectors whose length is not the most common
    one take no part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
                         & F.exists(v, lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("id"), v.alias("vector"))
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").head()
    rows = rows.where(F.size("vector") == (size["d"] if size else 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def build(classes: DataFrame) -> Index | None:
    """Index parameters from whole-table figures (rows, largest norm) and from
    inner products within a sample of at most ``SAMPLE`` vectors."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    figures = classes.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top"), F.max(F.size("vector")).alias("d")).head()
    if not figures["n"]:
        return None
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
    x = np.array([r[0] for r in sample], np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = (unit[:256] @ x.T / figures["top"])
    others = cosine[~np.eye(*cosine.shape, dtype=bool)]
    similarity = 0.5
    if len(others):
        share = 1.0 - min(0.5, NEAREST / figures["n"])
        normal = others.mean() + NormalDist().inv_cdf(share) * others.std()
        similarity = min(float(normal), float(np.quantile(others, min(share, 1 - 1 / len(others)))))
    similarity = min(max(similarity, 0.05), 0.95)
    groups = max(1, math.ceil(figures["n"] * figures["d"] * 8 / GROUP_BYTES))
    return Index.draw(figures["d"], figures["n"], figures["top"], similarity, groups)


def search(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, max_probes: int = MAX_PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every usable row with
    ``is_query`` (over ``vec_id``) its nearest found other rows; ``nearest``
    of them, or all others if there are fewer.

    ``score`` is the inner product in double precision; ties go to the smaller
    id. Equal vectors are one class that shows its ``nearest + 1`` smallest
    ids: no other of them can be among the nearest, as all score alike.
    Unusable rows (see ``usable``) are neither queries nor found; extra
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stored(usable(vectors), "vectors")
    # the row limit of each class is taken before the shuffle too
    within = Window.partitionBy("vector").orderBy("id")
    members = rows.withColumn("n", F.row_number().over(within)).where(F.col("n") <= nearest + 1)
    members = stored(members, "members")
    classes = members.where("n = 1").select("id", "vector")
    index = build(classes)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    d = index.directions.shape[1] - 1
    held = spark.sparkContext.broadcast(index)  # a few Gaussian directions a table

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for table, (group, numbers) in enumerate(zip(*held.value.buckets(_matrix(batch.column(1), d)), strict=True)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(numbers), table, np.int32)), pa.array(group),
                     pa.array(numbers), batch.column(0), batch.column(1)], names=["table", "g", "bucket", "id", "vector"])

    def probe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                out: list[tuple] = []
                for table, probes in enumerate(held.value.probes(_matrix(batch.column(1), d), max_probes)):
                    for row, (group, numbers) in enumerate(probes):
                        out.extend((table, g, row, numbers[group == g]) for g in np.unique(group).tolist())
                tables, groups, at, numbers = zip(*out, strict=True) if out else [()] * 4
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tables, pa.int32()), pa.array(groups, pa.int64()), batch.column(0).take(at),
                     batch.column(1).take(at), pa.array(numbers, pa.list_(pa.int64()))],
                    names=["table", "g", "query_id", "query", "probes"])

    hashed = stored(classes.select("id", "vector").mapInArrow(
        hash_rows, "table int, g long, bucket long, id long, vector array<double>"), "hashed")
    asking = rows.withColumnRenamed("id", "vec_id").where(is_query).select("vec_id", "vector")
    queries = asking.mapInArrow(
        probe_rows, "table int, g long, query_id long, query array<double>, probes array<long>")
    # a group with too many vectors (a hot bucket) is split; its queries go to every part
    most = max(1, 2 * GROUP_BYTES // (8 * d))
    parts = hashed.groupBy("table", "g").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
    keys = ["table", "g", "part"]
    left = queries.join(parts, ["table", "g"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = hashed.join(parts, ["table", "g"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    left = left.select(*keys, "query_id", "query", "probes")
    right = right.select(*keys, "bucket", "id", "vector")
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)

    def rerank(asked: pa.Table, known: pa.Table) -> pa.Table:
        query_ids, ids, scores = [], [], []
        if asked.num_rows and known.num_rows:
            x, q = _matrix(known.column("vector"), d), _matrix(asked.column("query"), d)
            names, q_ids = known.column("id").to_numpy(), asked.column("query_id").to_numpy()
            distinct, cell = np.unique(known.column("bucket").to_numpy(), return_inverse=True)
            probes = asked.column("probes").to_pylist()
            for first in range(0, len(q), 128):
                visited = np.zeros((min(128, len(q) - first), len(distinct)), bool)
                for i, numbers in enumerate(probes[first:first + 128]):
                    at = np.minimum(np.searchsorted(distinct, numbers), len(distinct) - 1)
                    visited[i, at[distinct[at] == numbers]] = True
                union = np.flatnonzero(visited.any(axis=0)[cell])
                rough = q[first:first + 128] @ x[union].T
                seen = visited[:, cell[union]]
                for i in range(len(visited)):
                    found = union[seen[i]]
                    if len(found) > nearest + 9:  # a little more, as the rough product rounds otherwise
                        found = found[np.argpartition(-rough[i][seen[i]], nearest + 8)[:nearest + 9]]
                    exact = (x[found] * q[first + i]).sum(axis=1)
                    best = np.lexsort((names[found], -exact))[:nearest + 1]
                    query_ids.append(np.full(len(best), q_ids[first + i]))
                    ids.append(names[found[best]])
                    scores.append(exact[best])
        flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.table({"query_id": flat(query_ids, np.int64), "id": flat(ids, np.int64), "score": flat(scores, np.float64)})

    names = members.alias("m").join(members.where("n = 1").select("vector", F.col("id").alias("class")), "vector").select(
        F.col("class").alias("id"), F.col("m.id").alias("vec_id"))

    def answers(left: DataFrame, right: DataFrame) -> DataFrame:
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            rerank, "query_id long, id long, score double")
        # tables may find the same class; its score is the same each time
        found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        by_class = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        found = found.withColumn("r", F.row_number().over(by_class)).where(F.col("r") <= nearest + 1).drop("r")
        found = found.join(names, "id").where(F.col("vec_id") != F.col("query_id"))
        ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= nearest)
        return stored(found.select("query_id", "rank", "vec_id", "score"), "answers")

    found = answers(left, right)
    counts = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("found"))
    short = stored(asking.join(counts, "vec_id", "left").where(
        F.coalesce("found", F.lit(0)) < min(nearest, rows.count() - 1)).select("vec_id", "vector"), "short")
    n_short = short.count()
    if n_short:
        # every block of these queries meets every block of vectors, each as one bucket
        blocks, sides = index.groups, math.ceil(n_short / most)
        left = short.select(F.pmod(F.xxhash64("vec_id"), F.lit(sides)).cast("int").alias("table"), "vec_id", "vector").select(
            "table", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("g"), F.lit(0).alias("part"), F.col("vec_id").alias("query_id"),
            F.col("vector").alias("query"), F.array(F.lit(0).cast("long")).alias("probes"))
        right = classes.select(
            F.explode(F.sequence(F.lit(0), F.lit(sides - 1))).alias("table"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long").alias("g"),
            F.lit(0).alias("part"), F.lit(0).cast("long").alias("bucket"), "id", "vector")
        exact = answers(left.toDF(*left.columns), right.toDF(*right.columns))
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(exact)
    return found.select("query_id", "rank", "vec_id", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row of ``embeddings`` whose vec_id is divisible
    by 20; see ``search``."""
    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
