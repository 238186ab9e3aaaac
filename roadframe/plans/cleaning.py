"""The cleaning pipeline: raw 29-column crash frame -> 22-column clean frame.

Only narrow steps (projections and filters), so Catalyst folds the chain
into one scan-filter-project stage. The not-null tests on borough and zip
reach the Parquet scan as pushed filters, and the scan reads only the 20
columns the pipeline uses. ``derive_features`` / ``select_rows`` /
``finish`` spell out the rules step by step; ``clean_crashes`` computes the
same result in a cheaper order (see its docstring).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roadframe import schema as S
from roadframe.functions.columns import c
from roadframe.operators import transforms as T


def derive_features(raw: DataFrame, via_epoch: bool = False) -> DataFrame:
    """Raw frame plus the derived columns, before any row is removed:
    ``date, year, month, day_of_week, hour, time_segment`` and, after casting
    the eight count columns to int, ``total_injured, total_killed,
    fatality_rate, total_cars``."""
    return (
        raw.transform(T.add_crash_date, via_epoch=via_epoch)
        .transform(T.add_date_parts)
        .transform(T.add_hour)
        .transform(T.add_time_segment)
        .transform(T.cast_to_int, S.COUNT_COLUMNS)
        .transform(T.add_totals)
        .transform(T.add_fatality_rate)
        .transform(T.add_vehicle_count)
    )


def select_rows(df: DataFrame) -> DataFrame:
    """Drop helper and unused columns, keep 1-3 vehicle crashes with a borough
    and a zip, default the missing factors."""
    return (
        df.transform(T.drop_columns, S.DROP_COLUMNS)
        .transform(T.filter_max_vehicles)
        .transform(T.require_not_null, [S.BOROUGH, S.ZIP_CODE])
        .transform(T.fill_factor_defaults)
    )


def finish(df: DataFrame) -> DataFrame:
    """Bucket factors, rename to clean names, type the zip and id, and drop
    every row that still has a null."""
    return (
        df.transform(T.bucketize)
        .transform(T.rename_columns, S.RENAME_MAP)
        .transform(T.cast_to_int, ["zip_code"])
        .transform(T.cast_to_int, ["crash_id"], "bigint")
        .transform(T.drop_incomplete)
    )


# Typed fields whose nulls decide which rows survive the final null check.
REQUIRED_TYPED = ["date", *S.COUNT_COLUMNS, S.ZIP_CODE, S.COLLISION_ID]


def clean_crashes(raw: DataFrame, via_epoch: bool = False) -> DataFrame:
    """Full cleaning pipeline; output columns are ``schema.CLEAN_COLUMNS``.

    The result is that of the step order above (derive, select rows, finish,
    then drop every row with a null in any clean column), computed in a
    cheaper order. Every derived clean column is non-null exactly when its
    typed inputs are: year, month and weekday need the parsed date; a total
    needs the four counts (four ints cannot overflow its bigint); the rate,
    time segment, vehicle count and the filled factors are never null. So the
    final null check equals a null check on the typed fields (date, counts,
    zip, id), applied before the other columns are derived.
    The plan's only filter then tests small expressions, and the derived
    columns are computed once, for the kept rows only. A null check over the
    finished columns would be pushed below the projections with every derived
    expression inlined, giving a generated method too large for the JIT.
    """
    typed = (
        raw.transform(T.add_vehicle_count)
        .transform(T.filter_max_vehicles)
        .transform(T.require_not_null, [S.BOROUGH, S.ZIP_CODE])
        .transform(T.add_crash_date, via_epoch=via_epoch)
        .transform(T.cast_to_int, [*S.COUNT_COLUMNS, S.ZIP_CODE])
        .transform(T.cast_to_int, [S.COLLISION_ID], "bigint")
        .transform(T.drop_incomplete, REQUIRED_TYPED)
    )
    return _derive_kept(typed)


def _derive_kept(typed: DataFrame) -> DataFrame:
    """The clean frame from typed rows that all survive."""
    derived = (
        typed.transform(T.add_date_parts)
        .transform(T.add_hour)
        .transform(T.add_time_segment)
        .transform(T.add_totals)
        .transform(T.add_fatality_rate)
    )
    out = (
        derived.transform(T.drop_columns, S.DROP_COLUMNS)
        .transform(T.fill_factor_defaults)
        .transform(T.bucketize)
        .transform(T.rename_columns, S.RENAME_MAP)
    )
    return out.select(*S.CLEAN_COLUMNS)


# Why a row is removed: the first test it fails, in the order of the steps.
REMOVAL_REASONS = ["vehicles", "borough", "zip_code", *(f"null_{name}" for name in (
    "date", *(S.RENAME_MAP[x] for x in S.COUNT_COLUMNS), "zip_code", "crash_id"))]


def _removal_reason() -> Column:
    """First failed test of a typed row; null for a row that stays."""
    tests = [(c("total_cars") >= S.MAX_VEHICLES_EXCLUSIVE), c(S.BOROUGH).isNull(), c("_zip_text").isNull(),
             *(c(field).isNull() for field in REQUIRED_TYPED)]
    first = F.when(tests[0], REMOVAL_REASONS[0])
    for test, reason in zip(tests[1:], REMOVAL_REASONS[1:]):
        first = first.when(test, reason)
    return first


def clean_crashes_counted(raw: DataFrame, via_epoch: bool = False) -> tuple[DataFrame, Observation]:
    """``clean_crashes`` and an observation that counts, within the same pass,
    the rows kept and those removed for each of ``REMOVAL_REASONS``.

    The counts are ready (``removal_rows``) once an action has read the whole
    clean frame, such as writing it. Counting needs every row, so the null
    tests are not pushed into the scan as they are without it."""
    counts = Observation()
    typed = (
        raw.transform(T.add_vehicle_count)
        .withColumn("_zip_text", c(S.ZIP_CODE))
        .transform(T.add_crash_date, via_epoch=via_epoch)
        .transform(T.cast_to_int, [*S.COUNT_COLUMNS, S.ZIP_CODE])
        .transform(T.cast_to_int, [S.COLLISION_ID], "bigint")
        .withColumn("_reason", _removal_reason())
    )
    counted = typed.observe(counts, F.count_if(F.col("_reason").isNull()).alias("kept"),
                            *(F.count_if(F.col("_reason") == reason).alias(reason) for reason in REMOVAL_REASONS))
    kept = counted.where(F.col("_reason").isNull()).drop("_reason", "_zip_text")
    return _derive_kept(kept), counts


def removal_rows(spark, counts: Observation) -> DataFrame:
    """``(reason, rows)`` of a finished ``clean_crashes_counted``; the kept rows as ``kept``."""
    found = counts.get
    return spark.createDataFrame([(reason, found[reason]) for reason in ["kept", *REMOVAL_REASONS]],
                                 "reason string, rows bigint")


def clean_crashes_stepwise(raw: DataFrame, via_epoch: bool = False) -> DataFrame:
    """The same result in the literal step order (kept for comparison)."""
    return raw.transform(derive_features, via_epoch=via_epoch).transform(select_rows).transform(finish)


def add_main_reason(clean: DataFrame) -> DataFrame:
    """``main_reason``: first non-null of the three factor columns."""
    return T.add_first_non_null(clean, ["factor_v1", "factor_v2", "factor_v3"], "main_reason")
