"""Helpers shared by the corpus operators: table access, stored intermediate
tables, global order with running sums, package shipping and word hashing."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadframe.session import fresh_shared_path

#: monotonically_increasing_id() puts the partition above this many bits
_POSITION_BITS = 33


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    survives lost executors. A filter on the columns ``by`` reads its folder only."""
    spark = df.sparkSession
    path = fresh_shared_path(spark, name)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered(df: DataFrame, keys: Sequence[Column], name: str, sums: Sequence[str] = ()) -> DataFrame:
    """``df`` in the global order of ``keys`` with ``rank`` (long, gapless from
    0) and, for every column in ``sums``, ``<column>_before``: the exact sum
    over all earlier rows.

    A range partitioning deals the rows (give keys that separate rows, so no
    key is hot), the sorted rows are stored with their place, and the totals
    of the partitions, one row each, give every partition its offset. No task
    sees more than its share.
    """
    spark = df.sparkSession
    placed = stored(
        df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_pid", F.shiftright("_place", _POSITION_BITS))
    totals = [F.count(F.lit(1)).alias("_rows"), *(F.sum(c).cast("long").alias(f"_{c}") for c in sums)]
    offsets, before = [], [0] * (1 + len(sums))
    for row in placed.groupBy("_pid").agg(*totals).orderBy("_pid").collect():  # one row per partition
        offsets.append((row["_pid"], *before))
        before = [b + (row[i + 1] or 0) for i, b in enumerate(before)]
    fields = ["_pid long", "_base long", *(f"_{c}_base long" for c in sums)]
    # bound: one row of longs per shuffle partition
    placed = placed.join(F.broadcast(spark.createDataFrame(offsets, ", ".join(fields))), "_pid")
    mask = (1 << _POSITION_BITS) - 1
    out = placed.withColumn("rank", F.col("_base") + F.col("_place").bitwiseAND(F.lit(mask)))
    if sums:
        earlier = Window.partitionBy("_pid").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        for c in sums:
            out = out.withColumn(f"{c}_before",
                                 F.col(f"_{c}_base") + F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("long"))
    return out.drop("_pid", "_place", "_base", *(f"_{c}_base" for c in sums))


def uniform(*parts) -> Column:
    """A hash draw in (0, 1) from the given columns (53 bits)."""
    bits = F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1))
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application
    (``addPyFile``), so they need no installed copy."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Spark's file server hands it to the workers, so it stays while the application runs
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), f"{os.path.basename(root)}_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
