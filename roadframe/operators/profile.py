"""Profiling: distinct counts, distinct values across columns, row counts.

All of these are aggregations with a map-side partial step, so the shuffle
carries at most one row per distinct value per task, however skewed the
values are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c


def distinct_counts(df: DataFrame, cols: Sequence[str],
                    aliases: Mapping[str, str] | None = None,
                    approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """One row with the number of distinct non-null values of each column,
    all computed in one job. ``approx`` uses HyperLogLog++ (one fixed-size
    sketch per task, no shuffle of values) with relative error ``rsd``."""
    if not cols:
        raise ValueError("distinct_counts needs at least one column")
    aliases = aliases or {}
    exprs = []
    for col in cols:
        name = aliases.get(col, f"distinct_{col}")
        agg = F.approx_count_distinct(c(col), rsd) if approx else F.count_distinct(c(col))
        exprs.append(agg.cast("bigint").alias(name))
    return df.agg(*exprs)


def distinct_values_across(df: DataFrame, cols: Sequence[str], out: str = "value") -> DataFrame:
    """One row per distinct non-null value found in any of ``cols`` (the union
    of their value sets). Values are unpivoted row-wise and de-duplicated
    with a partial aggregate, so no task ever holds a column's full list."""
    if not cols:
        raise ValueError("distinct_values_across needs at least one column")
    stacked = df.select(F.explode(F.array(*[c(col) for col in cols])).alias(out))
    return stacked.where(F.col(out).isNotNull()).distinct()


def distinct_values_array(df: DataFrame, cols: Sequence[str], out: str = "distinct_list") -> DataFrame:
    """The same set as ``distinct_values_across`` as one sorted array in one
    row. The distinct set is computed distributed first; only the distinct
    values (not the rows) meet in the final single-row aggregate, so use this
    form for low-cardinality columns only. Empty input gives ``[]``."""
    values = distinct_values_across(df, cols, out="v")
    return values.agg(F.array_sort(F.collect_list("v")).alias(out))


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """One row with the number of rows (counted on the executors)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(out))
