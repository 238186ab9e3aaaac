"""Train / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's Bernoulli split. With a seed it repeats only for the same input
    layout (partitioning and row order), and each part sorts every partition
    first; prefer ``stable_split`` for reproducible splits at scale."""
    return df.randomSplit(list(weights), seed)


def split_bucket(keys: Sequence[str], seed: int | str = 42, buckets: int = 100) -> Column:
    """Bucket in ``[0, buckets)`` from the md5 of ``seed:key[:key...]``: the
    first 8 hex digits as an unsigned 32-bit number, modulo ``buckets``.
    Key parts are joined as text (a null part is left out), so use several
    key columns only when their text cannot contain ``:``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[c(k).cast("string") for k in keys])
    head = F.substring(F.md5(text), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def _bounds(weights: Sequence[float], buckets: int) -> list[tuple[int, int]]:
    total = float(sum(weights))
    if not weights or total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    edges, acc = [0], 0.0
    for w in weights:
        acc += w / total
        edges.append(int(acc * buckets + 0.5))  # half up
    edges[-1] = buckets
    for w, lo, hi in zip(weights, edges[:-1], edges[1:]):
        if w > 0 and hi <= lo:
            raise ValueError(f"weight {w} is below one bucket of {buckets}; use more buckets")
    return list(zip(edges[:-1], edges[1:]))


def stable_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str],
                 seed: int = 42, buckets: int = 100) -> list[DataFrame]:
    """Split by a hash of the key columns: a narrow filter per part (no sort,
    no shuffle), identical for any partitioning or row order, and all rows of
    one key land in the same part. Weights are rounded to whole buckets."""
    bucket = split_bucket(keys, seed, buckets)
    return [df.where((bucket >= lo) & (bucket < hi)) for lo, hi in _bounds(weights, buckets)]


def with_split_part(df: DataFrame, weights: Sequence[float], keys: Sequence[str],
                    seed: int = 42, buckets: int = 100, out: str = "part") -> DataFrame:
    """The ``stable_split`` part number of every row as a column."""
    bucket = split_bucket(keys, seed, buckets)
    expr = None
    for i, (lo, hi) in enumerate(_bounds(weights, buckets)):
        cond = (bucket >= lo) & (bucket < hi)
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return df.withColumn(out, expr)
