"""Edge rows of the cleaning rules (one small frame per rule)."""

import pytest
from pyspark.sql import functions as F

from roadframe import schema as S
from roadframe.functions import columns as X
from roadframe.operators import transforms as T
from roadframe.plans.cleaning import clean_crashes


def raw_row():
    base = {c: None for c in S.RAW_COLUMNS}
    base.update({
        S.CRASH_DATE: "03/15/2021", S.CRASH_TIME: "14:05", S.BOROUGH: "QUEENS", S.ZIP_CODE: "11101",
        **{c: "0" for c in S.COUNT_COLUMNS},
        S.FACTOR_COLUMNS[0]: "Glare", S.COLLISION_ID: "7", S.VEHICLE_COLUMNS[0]: "Sedan",
    })
    return base


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in S.RAW_COLUMNS) for r in rows], S.raw_schema())


def test_time_segment_bounds_and_null(spark):
    df = spark.createDataFrame([(h,) for h in [5, 6, 11, 12, 17, 18, None]], "hour int")
    got = [r[0] for r in df.select(X.time_segment("hour")).collect()]
    assert got == ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening"]


def test_extract_hour(spark):
    df = spark.createDataFrame([("2:39",), ("14:05",), ("",), (None,), ("x:10",)], "t string")
    assert [r[0] for r in df.select(X.extract_hour("t")).collect()] == [2, 14, None, None, None]


def test_null_addend_and_zero_sum(spark):
    df = spark.createDataFrame([(1, None, 0, 0), (0, 0, 0, 0), (1, 1, 0, 2)], "a int, b int, k int, j int")
    out = df.select(X.null_strict_sum(["a", "b"]).alias("t"),
                    X.safe_rate("k", X.null_strict_sum(["a", "b"])).alias("r"),
                    X.safe_rate("j", "a").alias("r2")).collect()
    assert out[0]["t"] is None and out[0]["r"] == 0.0
    assert out[1]["t"] == 0 and out[1]["r"] == 0.0
    assert out[2]["r2"] == 0.67


def test_rate_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 7), (1, 199)], "k int, i int")  # 0.125, 0.005
    assert [r[0] for r in df.select(X.safe_rate("k", "i")).collect()] == [0.13, 0.01]


def test_blank_zip_and_bad_text_cast_to_null(spark):
    df = spark.createDataFrame([("     ",), ("12.5",), ("10001",), ("99999999999",)], "z string")
    assert [r[0] for r in df.select(X.to_int("z")).collect()] == [None, 12, 10001, None]


def test_bad_date_is_null(spark):
    df = spark.createDataFrame([("13/40/2021",), ("02/29/2021",), ("02/29/2020",)], "d string")
    got = [r[0] for r in df.select(X.parse_date("d").cast("string")).collect()]
    assert got == [None, None, "2020-02-29"]
    got2 = [r[0] for r in df.select(X.epoch_roundtrip_date("d").cast("string")).collect()]
    assert got2 == got


def test_vehicle_count_gap_and_none(spark):
    df = spark.createDataFrame([(None, None, "x", None, None), (None,) * 5, ("a", "b", "c", "d", None)],
                               ", ".join(f"v{i} string" for i in range(5)))
    got = [r[0] for r in df.select(X.highest_present([f"v{i}" for i in range(5)])).collect()]
    assert got == [3, 1, 4]


def test_bucket_rules(spark):
    df = spark.createDataFrame([(None,), ("Not In Any Bucket",), ("texting",), ("Texting",), ("80",), ("1",)],
                               "f string")
    filled = T.fill_defaults(df, {"f": "Unspecified"})
    got = [r[0] for r in T.bucketize(filled, ["f"]).collect()]
    assert got == ["External Force / Reaction", "Not In Any Bucket", "texting", "Driver Distraction",
                   "Poor Driving", "External Force / Reaction"]


def test_bucket_table_is_order_independent():
    X.check_buckets(S.FACTOR_BUCKETS)
    members = [m for ms in S.FACTOR_BUCKETS.values() for m in ms]
    assert len(members) == len(set(members))
    assert not set(S.FACTOR_BUCKETS) & set(members)


def test_bucket_equals_chained_replacement(spark):
    df = spark.createDataFrame([(m,) for ms in S.FACTOR_BUCKETS.values() for m in ms] + [("zz",)], "f string")
    chained = df
    for label, members in S.FACTOR_BUCKETS.items():
        chained = chained.withColumn("f", F.when(F.col("f").isin(members), label).otherwise(F.col("f")))
    assert sorted(chained.collect()) == sorted(T.bucketize(df, ["f"]).collect())


def test_fill_defaults_rejects_wrong_type(spark):
    df = spark.createDataFrame([(None,)], "n int")
    with pytest.raises(TypeError):
        T.fill_defaults(df, {"n": "x"})


def test_clean_pipeline_edge_rows(spark):
    rows = [
        raw_row(),                                                   # kept
        {**raw_row(), S.CRASH_TIME: None, S.COLLISION_ID: "8"},      # kept, evening
        {**raw_row(), S.PERSONS_INJURED: None, S.COLLISION_ID: "9"},  # null total -> dropped
        {**raw_row(), S.ZIP_CODE: "     ", S.COLLISION_ID: "10"},    # blank zip -> dropped
        {**raw_row(), S.CRASH_DATE: "13/40/2021", S.COLLISION_ID: "11"},  # bad date -> dropped
        {**raw_row(), S.VEHICLE_COLUMNS[3]: "Bike", S.COLLISION_ID: "12"},  # four vehicles -> dropped
        {**raw_row(), S.VEHICLE_COLUMNS[2]: "Bus", S.COLLISION_ID: "13"},   # gap -> 3
        {**raw_row(), S.FACTOR_COLUMNS[0]: None, S.COLLISION_ID: "14"},     # null factor
        {**raw_row(), S.BOROUGH: None, S.COLLISION_ID: "15"},               # no borough
    ]
    out = {r["crash_id"]: r for r in clean_crashes(frame(spark, rows)).collect()}
    assert sorted(out) == [7, 8, 13, 14]
    assert out[7]["time_segment"] == "afternoon" and out[8]["time_segment"] == "evening"
    assert out[13]["total_cars"] == 3 and out[7]["total_cars"] == 1
    assert out[14]["factor_v1"] == "External Force / Reaction"
    assert out[7]["factor_v1"] == "External Force / Reaction"  # Glare
    assert out[7]["factor_v2"] == "External Force / Reaction"  # null -> Unspecified -> bucket
    assert out[7]["day_of_week"] == 2 and out[7]["month"] == 3 and out[7]["year"] == 2021
    assert list(out[7].asDict()) == S.CLEAN_COLUMNS


def test_reordered_pipeline_equals_stepwise(spark, sf_dir):
    from roadframe.plans.cleaning import clean_crashes_stepwise
    from roadframe.sources.fixture import landed_fixture
    raw = landed_fixture(spark, sf_dir)
    fast, slow = clean_crashes(raw), clean_crashes_stepwise(raw)
    assert fast.columns == slow.columns
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_clean_filter_tests_only_typed_fields(spark, sf_dir):
    from roadframe.sources.fixture import landed_fixture
    plan = clean_crashes(landed_fixture(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and all("Personal Motorist Issue" not in f and "round(" not in f for f in filters)
    # the cheap plain casts, not the regex fallback (which would make the stage too big to JIT)
    assert all("RLIKE" not in f.upper() and "regexp_extract" not in f for f in filters)


def test_empty_inputs_are_rejected_or_trivial(spark):
    from roadframe.operators import profile, splits
    df = spark.createDataFrame([(3,)], "hour int")
    assert df.select(X.time_segment("hour", bounds=[])).first()[0] == "evening"
    with pytest.raises(ValueError):
        X.null_strict_sum([])
    with pytest.raises(ValueError):
        profile.distinct_counts(df, [])
    with pytest.raises(ValueError):
        profile.distinct_values_across(df, [])
    with pytest.raises(ValueError):
        splits.stable_split(df, [], ["hour"])
    with pytest.raises(ValueError):
        splits.stable_split(df, [0.5, -0.5], ["hour"])
    three = splits.stable_split(spark.range(3000).withColumnRenamed("id", "k"), [0.5, 0.3, 0.2], ["k"])
    sizes = [p.count() for p in three]
    assert sum(sizes) == 3000 and sizes[0] > sizes[1] > sizes[2]
