"""Column expressions. All are built-in Spark SQL functions, so they run
JVM-side inside whole-stage codegen; none needs a Python UDF.

Each function returns a ``Column``; frame-level steps in
``roadframe.operators`` compose them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadframe.schema import DATE_FORMAT, TIME_SEGMENT_OTHERWISE, TIME_SEGMENTS


def c(name: str | Column) -> Column:
    """Column by name; names with blanks, dots or backticks are quoted."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


def to_int(col: str | Column, dtype: str = "int") -> Column:
    """Text or number to int: the whole part of any decimal number (``7``,
    ``1.0``, ``12.5`` gives 12), null for anything else (blank, letters, out
    of range). Text read as it stands and text read with type inference give
    the same. Never fails a job under ANSI mode; the decimal path is only
    evaluated where the plain cast gives null."""
    number = c(col)
    return F.coalesce(number.try_cast(dtype), number.try_cast("decimal(38,18)").try_cast(dtype))


def parse_date(col: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Text to date with an explicit pattern; null for text that does not match
    or is not a real calendar date."""
    return F.try_to_date(c(col), fmt)


def epoch_roundtrip_date(col: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Text -> epoch seconds -> ISO ``yyyy-MM-dd`` text -> date: the
    round trip through ``unix_timestamp`` and ``from_unixtime``. Bad text
    gives null instead of failing."""
    seconds = F.unix_timestamp(F.try_to_timestamp(c(col), F.lit(fmt)))
    return F.from_unixtime(seconds, "yyyy-MM-dd").cast("date")


def extract_hour(col: str | Column, sep: str = ":") -> Column:
    """Hour of an ``H:mm`` text: the first ``sep``-separated field as int.
    A missing field or non-numeric text gives null."""
    return to_int(F.get(F.split(c(col), "\\Q" + sep + "\\E"), 0))  # literal, not a regex


def time_segment(hour: str | Column,
                 bounds: Sequence[tuple[int, str]] = TIME_SEGMENTS,
                 otherwise: str = TIME_SEGMENT_OTHERWISE) -> Column:
    """First-match CASE over ascending exclusive upper bounds. A null hour
    matches no bound and falls to ``otherwise``."""
    if not bounds:
        return F.lit(otherwise)
    expr = None
    for upper, label in bounds:
        cond = c(hour) < F.lit(upper)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def null_strict_sum(cols: Sequence[str | Column]) -> Column:
    """Sum of columns as bigint, where any null addend makes the total null.
    Int addends cannot overflow it; a sum beyond bigint is null instead of
    failing the job under ANSI mode."""
    if not cols:
        raise ValueError("null_strict_sum needs at least one column")
    total = c(cols[0]).cast("bigint")
    for col in cols[1:]:
        total = F.try_add(total, c(col).cast("bigint"))
    return total


def safe_rate(part: str | Column, rest: str | Column, scale: int = 2) -> Column:
    """``part / (part + rest)`` rounded half-up to ``scale`` digits when the
    denominator is positive, else 0.0 (a null denominator also gives 0.0)."""
    denom = F.try_add(c(part).cast("bigint"), c(rest).cast("bigint"))
    return (
        F.when(denom > 0, F.round(c(part) / denom, scale))
        .otherwise(F.lit(0.0))
        .cast("double")
    )


def highest_present(cols: Sequence[str | Column], floor: int = 1) -> Column:
    """1-based position of the last non-null column among ``cols`` (gaps are
    ignored); ``floor`` when none of the positions above it is set. Position 1
    itself is never tested, matching the vehicle-count rule."""
    expr = None
    for pos in range(len(cols), floor, -1):
        cond = c(cols[pos - 1]).isNotNull()
        expr = F.when(cond, pos) if expr is None else expr.when(cond, pos)
    return F.lit(floor) if expr is None else expr.otherwise(floor)


def bucket(col: str | Column, buckets: Mapping[str, Sequence[str]]) -> Column:
    """Replace a value by the label of the first bucket that lists it;
    unlisted values (and nulls) pass through unchanged.

    Applying the buckets in order as chained replacements equals this single
    first-match CASE, because bucket labels are not members of later lists
    (checked by ``check_buckets``)."""
    expr = None
    for label, members in buckets.items():
        cond = c(col).isin(list(members))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return c(col) if expr is None else expr.otherwise(c(col))


def check_buckets(buckets: Mapping[str, Sequence[str]]) -> None:
    """Raise if the ordered chain of replacements would differ from one lookup:
    a label that is itself a member of a later list would be re-bucketed."""
    labels = list(buckets)
    for i, label in enumerate(labels):
        for later in labels[i + 1:]:
            if label in buckets[later]:
                raise ValueError(f"label {label!r} is a member of later bucket {later!r}")


def first_non_null(cols: Sequence[str | Column]) -> Column:
    """First non-null value among ``cols``."""
    return F.coalesce(*[c(x) for x in cols])
