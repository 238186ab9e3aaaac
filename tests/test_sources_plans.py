"""Sources and the shape of the physical plans."""

import tempfile

import pytest

from roadframe import schema as S
from roadframe.plans import catalog, cleaning
from roadframe.sources import delimited
from roadframe.sources.fixture import landed_fixture, landed_fixture_path


def plan_text(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan details
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_csv_round_trip_keeps_blanks(spark):
    path = tempfile.mkdtemp(prefix="csv-") + "/out"
    df = spark.createDataFrame([("     ", None, "a,b")], "x string, y string, z string")
    delimited.write_delimited(df, path)
    back = delimited.read_delimited(spark, path, schema=df.schema).collect()[0]
    assert back["x"] == "     " and back["y"] is None and back["z"] == "a,b"


def test_inference_keeps_time_text(spark, sf_dir):
    inferred = delimited.read_delimited(spark, landed_fixture_path(spark, sf_dir, "csv"), infer=True)
    types = dict(inferred.dtypes)
    assert types[S.CRASH_TIME] == "string" and types[S.CRASH_DATE] == "string"
    assert types[S.PEDS_INJURED] == "int"


def test_register_view_and_preview(spark, sf_dir):
    raw = landed_fixture(spark, sf_dir)
    view = delimited.register_view(raw, "crashes_raw_t")
    assert view.count() == raw.count()
    top = delimited.preview(cleaning.clean_crashes(raw), 5, order_by=["crash_id"]).collect()
    ids = [r["crash_id"] for r in top]
    assert ids == sorted(ids) and len(ids) == 5


def read_schema(plan: str) -> str:
    return plan.split("ReadSchema: ")[1].split("\n")[0]


def test_clean_plan_is_one_narrow_stage_with_pushdown(spark, sf_dir):
    df = cleaning.clean_crashes(landed_fixture(spark, sf_dir))
    plan = plan_text(df)
    assert "Exchange" not in plan
    assert "IsNotNull(BOROUGH)" in plan and "IsNotNull(`ZIP CODE`)" in plan
    assert "*(" in plan  # whole-stage codegen


def test_clean_scan_prunes_unused_columns(spark, sf_dir):
    schema = read_schema(plan_text(cleaning.clean_crashes(landed_fixture(spark, sf_dir))))
    for unused in ("LATITUDE", "LONGITUDE", "LOCATION", "ON STREET NAME", "VEHICLE TYPE CODE 1",
                   "CONTRIBUTING FACTOR VEHICLE 4"):
        assert unused not in schema
    assert "BOROUGH" in schema


def test_distinct_values_across_uses_partial_aggregation(spark, sf_dir):
    df = catalog.QUERIES["distinct_values_across"](spark, sf_dir)
    plan = plan_text(df)
    assert plan.count("HashAggregate") >= 2 and "collect_list" not in plan


def test_land_as_parquet_round_trip(spark, sf_dir):
    from roadframe.sources.delimited import land_as_parquet
    out = tempfile.mkdtemp(prefix="landed-") + "/raw"
    csv = landed_fixture_path(spark, sf_dir, "csv")
    landed = land_as_parquet(spark, csv, out)
    text = delimited.read_delimited(spark, csv)
    assert landed.schema == text.schema
    assert landed.exceptAll(text).count() == 0 and text.exceptAll(landed).count() == 0


def test_join_summary_respects_disabled_broadcast(spark):
    from pyspark.sql import functions as F
    from roadframe.operators import joins
    big = spark.range(100).select((F.col("id") % 3).alias("k"))
    summ = big.groupBy("k").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.join_summary(big, summ, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joins.broadcast_byte_limit(spark) > 0


def test_explicit_schema_rejects_reordered_header(spark):
    import pytest
    path = tempfile.mkdtemp(prefix="csv-order-") + "/out"
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    delimited.write_delimited(df.select("b", "a"), path)
    with pytest.raises(Exception):
        delimited.read_delimited(spark, path, schema=df.schema).collect()
    assert delimited.read_delimited(spark, path, schema=df.select("b", "a").schema).collect()[0]["a"] == "1"


def test_land_as_parquet_partitioned(spark, sf_dir):
    import os
    from roadframe.sources.delimited import land_as_parquet
    out = tempfile.mkdtemp(prefix="landed-part-") + "/raw"
    landed = land_as_parquet(spark, landed_fixture_path(spark, sf_dir, "csv"), out, partition_by=[S.BOROUGH])
    assert any(d.startswith("BOROUGH=") for d in os.listdir(out))
    plan = plan_text(landed.where(f"`{S.BOROUGH}` = 'QUEENS'"))
    assert "PartitionFilters" in plan and "QUEENS" in plan.split("PartitionFilters")[1]


def test_landing_runs_no_method_too_long_to_compile(spark, monkeypatch, tmp_path):
    from datetime import datetime

    from pyspark.sql import DataFrameWriter

    from roadframe.session import compiled_methods
    from roadframe.sources import fixture
    key = "spark.sql.codegen.hugeMethodLimit"
    # every 50th key comes twice; nulls, and times next to midnight
    rows = [(k, k * 3, datetime(2020, 1 + k % 12, 1 + k % 28, 23 * (k % 2), 59)) for k in range(200)]
    rows += [(None, 5, datetime(2020, 5, 5)), (6, None, datetime(2020, 5, 5)), (7, 5, None)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    limits, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        limits.append(int(spark.conf.get(key))), write(self, path, *a, **k))[1])
    usual = spark.conf.get(key)
    landed = fixture.landed_fixture(spark, str(tmp_path))
    assert limits == [8000] and spark.conf.get(key) == usual
    # the same rows as the SQL text over the stored timestamps
    orders.createOrReplaceTempView("landing_orders")
    plain = spark.sql(fixture.fixture_sql("spark").replace("FROM orders", "FROM landing_orders")).drop("_k")
    assert landed.columns == plain.columns and landed.count() == plain.count() > 200
    assert not landed.exceptAll(plain).count() and not plain.exceptAll(landed).count()
    spark.conf.set(key, "100")
    try:
        with pytest.raises(ValueError), compiled_methods(spark):
            assert spark.conf.get(key) == "100"  # a lower limit stays
            raise ValueError
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, usual)
