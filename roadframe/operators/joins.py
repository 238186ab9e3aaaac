"""Joining a large frame to a per-key summary of itself.

Summaries keyed by a low-cardinality column (one row per borough, per
segment, ...) are tiny, but a shuffle join on such a key sends every row of
a hot key to one task. The summary is therefore materialized (checkpointed
to the shared folder, which also cuts its lineage), its row count is
checked, and it is broadcast only under a proven bound. Above the bound the
join is an ordinary shuffle join whose skewed partitions adaptive execution
splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c
from roadframe.session import checkpoint_dir

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
_FALLBACK_BROADCAST_BYTES = 10 * 1024 * 1024


def broadcast_byte_limit(spark) -> int:
    """The session's broadcast threshold in bytes (``-1`` disables broadcasts)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_FALLBACK_BROADCAST_BYTES))
    text = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30,
             "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}
    for suffix in sorted(units, key=len, reverse=True):
        number = text[: -len(suffix)].strip()
        if text.endswith(suffix) and number.lstrip("-").isdigit():
            return int(number) * units[suffix]
    return int(text)


def join_summary(large: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner",
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``large`` with a per-key ``summary`` on ``on``.

    The summary is checkpointed, then one job over the stored summary
    measures its row count and its size (the JSON text length of every row
    plus a fixed per-field overhead, which bounds the in-memory size of
    strings, arrays and maps by their content). It is broadcast only when
    the count is at most ``max_broadcast_rows`` and the size is within the
    session's ``spark.sql.autoBroadcastJoinThreshold``."""
    spark = summary.sparkSession
    checkpoint_dir(spark)
    small = summary.checkpoint(eager=True)
    per_row = 16 + 8 * len(small.columns)
    stats = small.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*[c(x) for x in small.columns])))), F.lit(0)).alias("text"),
    ).first()
    size = stats["text"] + stats["rows"] * per_row
    limit = broadcast_byte_limit(spark)
    if stats["rows"] <= max_broadcast_rows and limit >= 0 and size <= limit:
        return large.join(F.broadcast(small), list(on), how)
    return large.join(small, list(on), how)
