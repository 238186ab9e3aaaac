"""Edge cases found in review: ANSI-safe arithmetic, decimal-form whole
numbers, dedup key overlap, NaN in dropna, broadcast sizing, streaming
restart, checkpoint folder on a cluster, immutable recipes."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from roadframe import schema as S
from roadframe.functions import columns as X
from roadframe.operators import dedup, evaluate, joins
from roadframe.operators import transforms as T
from roadframe.plans.cleaning import clean_crashes
from roadframe.sources.delimited import read_delimited, write_delimited


def test_regression_metrics_constant_label_and_empty(spark):
    same = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, prediction double")
    off = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, prediction double")
    got = {r.metric: r.value for r in evaluate.regression_metrics(same, "y").collect()}
    assert got["rmse"] == 0.0 and got["r2"] != got["r2"]  # NaN
    got = {r.metric: r.value for r in evaluate.regression_metrics(off, "y").collect()}
    assert got["r2"] == float("-inf")
    empty = {r.metric: r.value for r in evaluate.regression_metrics(same.where("false"), "y").collect()}
    assert empty == {"rmse": None, "r2": None}


def test_large_sums_are_kept(spark):
    df = spark.createDataFrame([(2_000_000_000, 2_000_000_000), (1, 2), (None, 1)], "a int, b int")
    got = df.select(X.null_strict_sum(["a", "b"]).alias("t"), X.safe_rate("a", "b").alias("r")).collect()
    assert got[0]["t"] == 4_000_000_000 and got[0]["r"] == 0.5
    assert got[1]["t"] == 3 and got[1]["r"] == 0.33
    assert got[2]["t"] is None and got[2]["r"] == 0.0


def test_to_int_takes_the_whole_part_of_any_number(spark):
    vals = ["1.0", "-2.00", " 3. ", "12.5", "-12.9", "1e3", "abc", "7", None, "99999999999.0", "2147483647.9", "."]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r[0] for r in df.select(X.to_int("s")).collect()] == [
        1, -2, 3, 12, -12, 1000, None, 7, None, None, 2147483647, None]


def test_explicit_and_inferred_reads_keep_the_same_rows(spark, tmp_path):
    """Decimal counts and zips keep their crash under either read."""
    base = {S.CRASH_DATE: "03/15/2021", S.CRASH_TIME: "8:30", S.BOROUGH: "QUEENS", S.ZIP_CODE: "11201",
            **dict.fromkeys(S.COUNT_COLUMNS, "0")}
    changed = [{}, {S.COUNT_COLUMNS[0]: "1.0"}, {S.ZIP_CODE: "11201.0"}, {S.COUNT_COLUMNS[0]: "12.5"}]
    rows = [tuple({**base, **x, S.COLLISION_ID: str(i)}.get(col) for col in S.RAW_COLUMNS) for i, x in enumerate(changed)]
    path = str(tmp_path / "crashes")
    write_delimited(spark.createDataFrame(rows, S.raw_schema()), path)
    frames = [sorted(clean_crashes(read_delimited(spark, path, infer=infer)).collect()) for infer in (False, True)]
    assert len(frames[0]) == 4 and frames[0] == frames[1]


def test_dedup_order_by_may_name_the_key(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 5, "b"), (2, 1, "c")], "k int, o int, r string")
    got = {r.k: r.o for r in dedup.dedup_by_key(df, ["k"], order_by=["k", "o"], descending=True).collect()}
    assert got == {1: 5, 2: 1}
    assert dedup.dedup_by_key(df, ["k"], order_by=["k"]).count() == 2


def test_drop_incomplete_drops_nan_like_dropna(spark):
    df = spark.range(4).select(F.sqrt(F.col("id") - 1).alias("x"), F.col("id"))
    assert not dict((f.name, f.nullable) for f in df.schema.fields)["id"]
    assert T.drop_incomplete(df).count() == df.dropna().count() == 3


def test_broadcast_limit_units_and_measured_size(spark):
    for value, want in [("10m", 10 << 20), ("1t", 1 << 40), ("2048", 2048), ("-1", -1)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
        assert joins.broadcast_byte_limit(spark) == want
    # a summary of few rows with long text is measured by its content
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2048")
    try:
        big = spark.range(100_000).select((F.col("id") % 2).alias("k"))  # too big to broadcast
        wide = big.groupBy("k").agg(F.lit("x" * 5000).alias("text"))
        plan = joins.join_summary(big, wide, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan  # 2 rows, but 10 KB of text
        narrow = big.groupBy("k").count()
        plan = joins.join_summary(big, narrow, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_restart_without_explicit_checkpoint(spark, sf_dir):
    from roadframe.plans import catalog
    from roadframe.sources.fixture import landed_fixture_path
    from roadframe.streaming.ingest import start_clean_ingest
    src = landed_fixture_path(spark, sf_dir, "csv")
    src = src[len("file:"):] if src.startswith("file:") else src
    parts = sorted(f for f in os.listdir(src) if f.endswith(".csv"))
    work, sink = tempfile.mkdtemp(prefix="restart-src-"), tempfile.mkdtemp(prefix="restart-sink-")
    for f in parts[:2]:
        shutil.copy(os.path.join(src, f), work)
    start_clean_ingest(spark, work, sink).awaitTermination()
    for f in parts[2:]:
        shutil.copy(os.path.join(src, f), work)
    start_clean_ingest(spark, work, sink).awaitTermination()  # same sink: resumes
    got = sorted(spark.read.parquet(sink).collect())
    assert got == sorted(catalog.QUERIES["clean_pipeline"](spark, sf_dir).collect())


class _SparkConf:  # like SparkConf: a missing key gives the default
    def get(self, key, default=None):
        return default


class _SqlConf:  # like spark.conf: a missing key without default raises
    def get(self, key, *default):
        if default:
            return default[0]
        raise KeyError(key)


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return _SparkConf()


class _Session:
    def __init__(self, master, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _SqlConf()


def test_no_local_checkpoint_folder_on_a_cluster():
    from roadframe.session import checkpoint_dir, checkpoint_root
    with pytest.raises(RuntimeError, match="shared storage"):
        checkpoint_dir(_Session("yarn"))
    with pytest.raises(RuntimeError, match="shared storage"):
        checkpoint_dir(_Session("local[4]"))
    # a folder set with sc.setCheckpointDir counts as configured (Spark adds a per-app folder)
    assert checkpoint_root(_Session("yarn", "hdfs:///ckpt/1f2e-app")) == "hdfs:///ckpt"


def test_runner_refuses_to_overwrite_a_named_landing_folder(spark, sf_dir):
    from roadframe.__main__ import run
    from roadframe.sources.fixture import landed_fixture_path
    existing = tempfile.mkdtemp(prefix="land-existing-")
    with pytest.raises(Exception, match="(?i)already exists"):
        run(spark, landed_fixture_path(spark, sf_dir, "csv"), tempfile.mkdtemp(), [], land=existing)


def test_recipes_are_hashable_read_only_and_picklable():
    import copy
    import dataclasses
    import pickle
    from roadframe.plans.recipes import RECIPES
    assert len({RECIPES["1a"], RECIPES["4"]}) == 2
    with pytest.raises(TypeError):
        RECIPES["4"].estimator_params["max_depth"] = 10
    assert pickle.loads(pickle.dumps(RECIPES["4"])) == RECIPES["4"]
    assert copy.deepcopy(RECIPES["1a"]) == RECIPES["1a"]
    assert dict(dataclasses.asdict(RECIPES["4"])["estimator_params"]) == {"max_bins": 10, "max_depth": 5}


def test_dedup_key_only_order_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z")], "k int, r string").repartition(3)
    got = {r.k: r.r for r in dedup.dedup_by_key(df, ["k"], order_by=["k"]).collect()}
    assert got == {1: "a", 2: "z"}  # ties broken by the remaining columns


def test_fill_defaults_replaces_nan_like_fillna(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "x double")
    assert [r.x for r in T.fill_defaults(df, {"x": 0.0}).collect()] == [0.0, 0.0, 2.0]


def test_accuracy_on_text_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "label string, prediction string")
    assert evaluate.classification_metrics(df).first()["value"] == 0.5


def test_split_bounds_refuse_empty_parts(spark):
    from roadframe.operators import splits
    with pytest.raises(ValueError, match="below one bucket"):
        splits.stable_split(spark.range(10), [0.995, 0.005], ["id"])


def test_drop_incomplete_with_dotted_names(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "`a.b` int, c int")
    assert T.drop_incomplete(df, ["c"]).count() == 1 and T.drop_incomplete(df).count() == 1


def test_materialize_empty_partitioned_table(spark):
    from roadframe.operators import models
    empty = spark.range(0).withColumn("_part", F.lit(0))
    assert models.materialize(empty, "empty", partition_by=["_part"]).count() == 0
