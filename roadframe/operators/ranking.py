"""Category indices for columns with any number of values.

Spark's indexer brings every distinct value to the driver. Here the values
are counted, put in order by a range sort, and numbered from the sizes of the
sorted partitions; the numbers are joined back. The driver sees one row per
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c
from roadframe.operators.features import INVALID_MODES
from roadframe.operators.joins import join_summary
from roadframe.session import fresh_shared_path

# monotonically_increasing_id() holds the partition above this many bits
_PARTITION_SHIFT = 33


def ranked(df: DataFrame, keys: Sequence[Column], out: str = "rank") -> DataFrame:
    """``df`` with its place (bigint from 0, gapless) in the order of ``keys``,
    which should separate the rows. The sorted rows are stored once, so a
    retried task cannot number them anew."""
    spark = df.sparkSession
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id())
    path = fresh_shared_path(spark, "ranked")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumn(
        "_part", F.shiftright("_place", _PARTITION_SHIFT))
    first, offsets = 0, []
    for row in placed.groupBy("_part").count().orderBy("_part").collect():  # one row per partition
        offsets.append((row["_part"], first))
        first += row["count"]
    # bound: two longs per shuffle partition
    offset_df = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _first bigint"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return placed.join(offset_df, "_part").withColumn(out, F.col("_first") + within).drop("_place", "_part", "_first")


def label_ranking(df: DataFrame, col: str) -> DataFrame:
    """``(value, index)`` of every distinct non-null value of ``col``: values
    as text, indices (double from 0) by descending count, ties by text
    ascending, as ``features.index_categories`` gives them."""
    values = df.select(c(col).cast("string").alias("value")).where(F.col("value").isNotNull())
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("_n"))
    return ranked(counts, [F.desc("_n"), F.col("value")], "index").select("value", F.col("index").cast("double").alias("index"))


def index_by_ranking(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, invalid: str = "keep",
                     suffix: str = "_idx") -> DataFrame:
    """``df`` with ``<col>_idx`` for each of ``cols``, ranked on ``fit_on``
    (default ``df``). Unseen values and nulls: ``keep`` gives them the number
    of known values, ``error`` fails, ``skip`` drops the row. A ranking is
    broadcast only when its measured size allows it."""
    if invalid not in INVALID_MODES:
        raise ValueError(f"invalid must be one of {INVALID_MODES}")
    fit_on = df if fit_on is None else fit_on
    for col in cols:
        out = col + suffix
        ranking = label_ranking(fit_on, col).withColumnsRenamed({"value": "_value", "index": out})
        keyed = df.withColumn("_value", c(col).cast("string"))
        df = join_summary(keyed, ranking, ["_value"], "inner" if invalid == "skip" else "left").drop("_value")
        if invalid == "keep":
            known = float(ranking.count())
            df = df.withColumn(out, F.coalesce(c(out), F.lit(known)))
        elif invalid == "error":
            problem = F.concat(F.lit(f"unseen value in {col}: "), F.coalesce(c(col).cast("string"), F.lit("null")))
            df = df.withColumn(out, F.when(c(out).isNull(), F.raise_error(problem).cast("double")).otherwise(c(out)))
    return df
