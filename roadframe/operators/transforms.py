"""Frame-to-frame steps. Each takes a DataFrame and returns a DataFrame, so a
pipeline is a chain of ``df.transform(step, ...)`` calls that Catalyst
collapses into a few projections and filters (all narrow: no step here
shuffles).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe import schema as S
from roadframe.functions import columns as X


# --- projections ----------------------------------------------------------------

def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep ``cols`` in the given order."""
    return df.select(*[X.c(col) for col in cols])


def drop_columns(df: DataFrame, cols: Sequence[str] = S.DROP_COLUMNS) -> DataFrame:
    """Drop ``cols``; names that are not present are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = S.RENAME_MAP) -> DataFrame:
    """Rename by map in one projection; names that are not present are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present)


def cast_to_int(df: DataFrame, cols: Sequence[str], dtype: str = "int") -> DataFrame:
    """Cast columns to ``dtype``; text that is not a number becomes null
    instead of failing the job (see ``to_int``)."""
    return df.withColumns({col: X.to_int(col, dtype) for col in cols})


# --- dates and times --------------------------------------------------------------

def add_crash_date(df: DataFrame, src: str = S.CRASH_DATE, out: str = "date",
                   fmt: str = S.DATE_FORMAT, via_epoch: bool = False) -> DataFrame:
    """Parse ``src`` text into a date column ``out``. ``via_epoch`` takes the
    route through epoch seconds and ISO text; both agree on valid input and
    give null on invalid input."""
    parse = X.epoch_roundtrip_date if via_epoch else X.parse_date
    return df.withColumn(out, parse(src, fmt))


def add_date_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``year``, ``month`` and ``day_of_week`` (1 = Sunday .. 7 = Saturday)."""
    d = X.c(date_col)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "day_of_week": F.dayofweek(d),
    })


def add_hour(df: DataFrame, src: str = S.CRASH_TIME, out: str = "hour") -> DataFrame:
    """Hour of an ``H:mm`` time text as int (null when unreadable)."""
    return df.withColumn(out, X.extract_hour(src))


def add_time_segment(df: DataFrame, hour: str = "hour", out: str = "time_segment") -> DataFrame:
    """Bucket an hour into night / morning / afternoon / evening."""
    return df.withColumn(out, X.time_segment(hour))


# --- totals and rates --------------------------------------------------------------

def add_totals(df: DataFrame, injured: Sequence[str] = S.INJURED_COLUMNS,
               killed: Sequence[str] = S.KILLED_COLUMNS) -> DataFrame:
    """``total_injured`` and ``total_killed`` as null-strict sums."""
    return df.withColumns({
        "total_injured": X.null_strict_sum(injured),
        "total_killed": X.null_strict_sum(killed),
    })


def add_fatality_rate(df: DataFrame, killed: str = "total_killed",
                      injured: str = "total_injured", out: str = "fatality_rate") -> DataFrame:
    """killed / (injured + killed), two digits, 0 when nobody was hurt."""
    return df.withColumn(out, X.safe_rate(killed, injured))


def add_vehicle_count(df: DataFrame, vehicle_cols: Sequence[str] = S.VEHICLE_COLUMNS,
                      out: str = "total_cars") -> DataFrame:
    """Number of vehicles: highest vehicle-code position that is set, else 1."""
    return df.withColumn(out, X.highest_present(vehicle_cols))


def add_first_non_null(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """``out`` = first non-null value among ``cols``."""
    return df.withColumn(out, X.first_non_null(cols))


# --- filters and null handling ----------------------------------------------------

def filter_max_vehicles(df: DataFrame, col: str = "total_cars",
                        limit: int = S.MAX_VEHICLES_EXCLUSIVE) -> DataFrame:
    """Keep rows with ``col < limit`` (1 to 3 vehicles by default)."""
    return df.filter(X.c(col) < F.lit(limit))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every one of ``cols`` is not null."""
    cond = None
    for col in cols:
        term = X.c(col).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column (or any of ``subset``; an empty
    subset drops nothing).

    Like ``dropna``, NaN in a float or double column counts as missing.
    Columns the schema marks non-nullable cannot hold a null, so only the
    nullable and the floating-point ones are tested: the same rows, with a
    smaller filter (Catalyst inlines each tested column's expression into it)."""
    wanted = df.columns if subset is None else list(subset)
    missing = [col for col in wanted if col not in df.columns]
    if missing:
        raise KeyError(f"no columns {missing}")
    fields = {f.name: f for f in df.schema.fields}
    cond = None
    for col in wanted:
        f = fields[col]
        floating = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        if not (f.nullable or floating):
            continue
        term = X.c(col).isNotNull()
        if floating:
            term = term & ~F.isnan(X.c(col))
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def fill_defaults(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Replace nulls (and NaN in float/double columns) column by column. The
    value's type must suit the column:
    a mismatch raises here instead of being silently skipped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for col, value in mapping.items():
        if col not in types:
            raise KeyError(f"no column {col!r}")
        dtype = types[col]
        ok = (
            (isinstance(dtype, T.StringType) and isinstance(value, str))
            or (isinstance(dtype, T.NumericType) and isinstance(value, (int, float))
                and not isinstance(value, bool))
            or (isinstance(dtype, T.BooleanType) and isinstance(value, bool))
        )
        if not ok:
            raise TypeError(f"fill value {value!r} does not suit column {col!r} of type {dtype}")
    def filled(col, value):
        fill = F.lit(value).cast(types[col])
        if isinstance(types[col], (T.FloatType, T.DoubleType)):  # like fillna: NaN too
            return F.when(X.c(col).isNull() | F.isnan(X.c(col)), fill).otherwise(X.c(col))
        return F.coalesce(X.c(col), fill)

    return df.withColumns({col: filled(col, value) for col, value in mapping.items()})


def fill_factor_defaults(df: DataFrame, cols: Sequence[str] = S.BUCKETED_FACTORS,
                         value: str = S.FACTOR_DEFAULT) -> DataFrame:
    """Missing contributing factors become ``Unspecified``."""
    return fill_defaults(df, {col: value for col in cols})


# --- category buckets -----------------------------------------------------------

def bucketize(df: DataFrame, cols: Sequence[str] = S.BUCKETED_FACTORS,
              buckets: Mapping[str, Sequence[str]] = S.FACTOR_BUCKETS) -> DataFrame:
    """Replace listed values by their bucket label in each of ``cols``; one
    CASE expression per column, all in a single projection."""
    X.check_buckets(buckets)
    return df.withColumns({col: X.bucket(col, buckets) for col in cols})
