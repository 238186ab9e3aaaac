"""Indexing, one-hot, assembly and metrics."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from roadframe.operators import evaluate, features


def test_indexer_frequency_then_text_order(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", "b", "a", "d"]], "v string")
    model = features.index_categories(["v"], invalid="keep").fit(df)
    assert list(model.labelsArray[0]) == ["a", "b", "c", "d"]
    nums = spark.createDataFrame([(v,) for v in [10, 9, 9, 10, 100]], "v int")
    m2 = features.index_categories(["v"]).fit(nums)
    assert list(m2.labelsArray[0]) == ["10", "9", "100"]  # text order breaks the tie


def test_keep_vs_error_and_one_hot_width(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "v string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    keep = features.index_categories(["v"], invalid="keep").fit(train)
    got = [r[0] for r in keep.transform(test).select("v_idx").collect()]
    assert got == [0.0, 3.0, 3.0]
    enc = features.one_hot(["v_idx"], ["v_ohe"]).fit(keep.transform(train))
    out = enc.transform(keep.transform(test)).select(
        features.one_hot_slot("v_ohe").alias("slot"), features.vector_width("v_ohe").alias("w")).collect()
    assert [(r.slot, r.w) for r in out] == [(0, 3), (-1, 3), (-1, 3)]
    err = features.index_categories(["v"], invalid="error").fit(train)
    enc2 = features.one_hot(["v_idx"], ["v_ohe"]).fit(err.transform(train))
    w = enc2.transform(err.transform(train)).select(features.vector_width("v_ohe")).first()[0]
    assert w == 2
    with pytest.raises(Exception):
        err.transform(test).collect()


def test_one_hot_rows_sum_to_zero_or_one(spark):
    df = spark.createDataFrame([(v,) for v in "abcabdde"], "v string")
    idx = features.index_categories(["v"]).fit(df).transform(df)
    oh = features.one_hot(["v_idx"], ["o"]).fit(idx).transform(idx)
    sums = {r[0] for r in oh.select(F.aggregate(features.vector_elements("o"), F.lit(0.0),
                                                lambda a, x: a + x)).collect()}
    assert sums <= {0.0, 1.0}


def test_assemble_skip_and_error(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 1.0), (3, None)], "a int, b double")
    skip = features.assemble(["a", "b"], invalid="skip").transform(df)
    assert skip.count() == 1
    with pytest.raises(Exception):
        features.assemble(["a", "b"]).transform(df).collect()


def test_classification_metric_matches_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0), (1.0, 1.0)], "label double, prediction double")
    mine = evaluate.classification_metrics(df).collect()[0]
    ref = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert mine["metric"] == "accuracy" and abs(mine["value"] - ref) < 1e-12
    assert 0.0 <= mine["value"] <= 1.0


def test_regression_metrics_match_evaluator(spark):
    df = spark.createDataFrame([(3.0, 2.5), (1.0, 1.5), (2.0, 2.0), (7.0, 5.0)], "y double, prediction double")
    got = {r.metric: r.value for r in evaluate.regression_metrics(df, "y").collect()}
    for name in ("rmse", "r2"):
        ref = RegressionEvaluator(labelCol="y", metricName=name).evaluate(df)
        assert abs(got[name] - ref) < 1e-9
