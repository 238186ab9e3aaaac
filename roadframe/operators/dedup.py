"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                 descending: bool = False) -> DataFrame:
    """Keep one row per distinct ``keys``.

    Without ``order_by`` any one row of each key survives (Spark's
    ``dropDuplicates``, a sort aggregate with a map-side partial step).

    With ``order_by`` the survivor is deterministic: the row with the smallest
    (or, with ``descending``, largest) ``order_by`` values, ties broken by the
    remaining columns; a null ``order_by`` value counts as the smallest. It
    is computed as a ``min``/``max`` over a struct, which
    is also partially aggregated before the shuffle, so a key holding a third
    of all rows still costs one row per task in the shuffle (a window with
    ``row_number`` would send the whole hot key to a single task).
    """
    keys = list(keys)
    if not order_by:
        return df.dropDuplicates(keys)
    order_by = [col for col in order_by if col not in keys]  # constant within a key
    rest = [col for col in df.columns if col not in keys and col not in order_by]
    packed = F.struct(*[c(col).alias(f"_o{i}") for i, col in enumerate(order_by)],
                      *[c(col).alias(f"_r{i}") for i, col in enumerate(rest)])
    pick = F.max(packed) if descending else F.min(packed)
    agg = df.groupBy(*[c(k) for k in keys]).agg(pick.alias("_best"))
    out = {**{col: F.col(f"_best._o{i}") for i, col in enumerate(order_by)},
           **{col: F.col(f"_best._r{i}") for i, col in enumerate(rest)}}
    return agg.select(*[c(k) for k in keys], *[out[col].alias(col) for col in df.columns if col in out]) \
        .select(*[c(col) for col in df.columns])
