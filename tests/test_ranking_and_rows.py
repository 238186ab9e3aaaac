"""Label ranking, counted cleaning and checked delimited rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.operators import features, ranking
from roadframe.plans import catalog, cleaning
from roadframe.sources import delimited


def test_ranking_equals_the_indexer(spark):
    rows = [(v,) for v in ["b", "a", "c", "c", "b", "a", "d", None, "", "é"]] + [("hot",)] * 500
    df = spark.createDataFrame(rows, "v string")
    labels = features.index_categories(["v"]).fit(df).labelsArray[0]
    found = {r["value"]: r["index"] for r in ranking.label_ranking(df, "v").collect()}
    assert found == {v: float(i) for i, v in enumerate(labels)}
    keep = ranking.index_by_ranking(spark.createDataFrame([("a",), ("z",), (None,)], "v string"), ["v"], fit_on=df)
    assert {r["v"]: r["v_idx"] for r in keep.collect()} == {"a": found["a"], "z": float(len(labels)), None: float(len(labels))}
    skip = ranking.index_by_ranking(spark.createDataFrame([("a",), ("z",)], "v string"), ["v"], fit_on=df, invalid="skip")
    assert [r["v"] for r in skip.collect()] == ["a"]
    with pytest.raises(Exception, match="unseen value in v: z"):
        ranking.index_by_ranking(spark.createDataFrame([("z",)], "v string"), ["v"], fit_on=df, invalid="error").collect()
    with pytest.raises(ValueError):
        ranking.index_by_ranking(df, ["v"], invalid="other")


def test_a_million_values(spark):
    """Ranks of a million values, none of them on the driver."""
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("v"))
    df = df.unionByName(df.where("v > 'v0999989'"))  # the last ten twice
    out = ranking.index_by_ranking(df, ["v"])
    first = out.where("v_idx < 10").select("v", "v_idx").distinct().orderBy("v_idx").collect()
    assert [r["v"] for r in first] == [f"v{i:07d}" for i in range(999_990, 1_000_000)]
    checked = out.where("v < 'v0999990'").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v_idx") != F.substring("v", 2, 7).cast("double") + 10).alias("off")).first()
    assert checked["n"] == 999_990 and checked["off"] == 0


def test_no_values_to_rank(spark):
    empty = spark.createDataFrame([], "v string")
    assert ranking.label_ranking(empty, "v").count() == 0
    assert ranking.index_by_ranking(spark.createDataFrame([("a",)], "v string"), ["v"], fit_on=empty).first()["v_idx"] == 0.0


def test_counts_come_with_the_one_pass(spark, sf_dir):
    raw = catalog.raw(spark, sf_dir)
    kept, counts = cleaning.clean_crashes_counted(raw)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    rows = kept.collect()
    found = {r["reason"]: r["rows"] for r in cleaning.removal_rows(spark, counts).collect()}
    assert found["kept"] == len(rows) == cleaning.clean_crashes(raw).count()
    assert sum(found.values()) == raw.count() and set(found) == {"kept", *cleaning.REMOVAL_REASONS}


def test_checked_rows(spark, tmp_path):
    schema = T.StructType([T.StructField(x, T.StringType()) for x in "abc"])
    path = tmp_path / "rows.csv"
    path.write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,"11,12\n13,"x, ""y""",\n\n14,"line\nbreak",15\n')
    kept, rejected = delimited.read_delimited_checked(spark, str(path), schema)
    assert sorted(tuple(r) for r in kept.collect()) == [("1", "2", "3"), ("13", 'x, "y"', None)]
    bad = {r["record"] for r in rejected.collect()}
    assert {"4,5", "6,7,8,9", '10,"11,12', '14,"line'} <= bad
    assert all(r["file"].endswith("rows.csv") for r in rejected.collect())
    whole = tmp_path / "lines.csv"
    whole.write_text('a,b,c\n14,"line\nbreak",15\n4,5\n1,2,3\n')
    kept, rejected = delimited.read_delimited_checked(spark, str(whole), schema, multi_line=True)
    assert sorted(tuple(r) for r in kept.collect()) == [("1", "2", "3"), ("14", "line\nbreak", "15")]
    assert [r["record"] for r in rejected.collect()] == ["4,5"]


def test_wrong_header_still_fails(spark, tmp_path):
    schema = T.StructType([T.StructField(x, T.StringType()) for x in "abc"])
    path = tmp_path / "rows.csv"
    path.write_text("b,a,c\n1,2,3\n")
    with pytest.raises(Exception):
        delimited.read_delimited_checked(spark, str(path), schema)
