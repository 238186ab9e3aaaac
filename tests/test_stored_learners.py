"""Model store, node tables, and the search's stored predictions."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from roadframe.operators import features, model_store, models
from roadframe.plans import catalog, recipes


@pytest.fixture(scope="module")
def run5(spark, sf_dir):
    return catalog.fitted(spark, sf_dir, "5")


def test_second_request_fits_nothing(spark, sf_dir, run5, monkeypatch):
    def fail(*args, **kwargs):
        raise AssertionError("fitted again")
    monkeypatch.setattr(recipes, "run_recipe", fail)
    again = catalog.fitted(spark, sf_dir, "5")
    assert again.model_path == run5.model_path
    assert again.metrics().collect() == run5.metrics().collect()
    catalog.QUERIES["feature_importance"](spark, sf_dir).collect()


def test_key_follows_recipe_and_input(spark, sf_dir, run5, monkeypatch):
    from dataclasses import replace
    source = catalog.raw(spark, sf_dir)
    clean = catalog.clean(spark, sf_dir)
    asked = []
    monkeypatch.setattr(model_store, "find", lambda spark, key: asked.append(key) or run5.model_path.rsplit("/", 1)[0])
    recipe = recipes.RECIPES["5"]
    recipes.stored_run(clean, recipe, source)
    recipes.stored_run(clean, replace(recipe, seed=43), source)
    recipes.stored_run(clean, recipe, source, partitions=16)
    recipes.stored_run(clean, recipe, spark.read.parquet(f"{sf_dir}/orders.parquet"))
    recipes.stored_run(clean, recipe)  # by the rows
    recipes.stored_run(clean.repartition(7), recipe)  # their order does not count
    recipes.stored_run(clean.where("month < 12"), recipe)
    assert len(set(asked[:5])) == 5 and asked[4] == asked[5] and asked[6] != asked[5]


def test_failed_attempt_is_not_found(spark):
    key = model_store.fingerprint("test", "failed")
    spark.range(1).write.parquet(model_store.new_folder(spark, key) + "/input")
    assert model_store.find(spark, key) is None
    folder = model_store.finish(spark, key, "somewhere")
    assert folder == model_store.find(spark, key) == "somewhere"
    assert model_store.finish(spark, key, "elsewhere") == "somewhere"  # the first one stays


@pytest.mark.parametrize("name", ["1a", "2b", "4", "5"])
def test_node_table_is_the_model(spark, sf_dir, name):
    run = catalog.fitted(spark, sf_dir, name)
    nodes = run.nodes()
    learner = run.model.stages[-1]
    trees = learner.trees if hasattr(learner, "trees") else [learner]
    counts = {r["tree"]: r["count"] for r in nodes.groupBy("tree").count().collect()}
    assert counts == {i: t.numNodes for i, t in enumerate(trees)}
    inner = nodes.where("feature IS NOT NULL")
    assert inner.where("gain <= 0 OR left IS NULL OR right IS NULL OR (threshold IS NULL) = (categories IS NULL)").count() == 0
    # children share their parent's weight
    child = nodes.select("tree", F.col("node").alias("left"), F.col("weight").alias("lw"))
    other = nodes.select("tree", F.col("node").alias("right"), F.col("weight").alias("rw"))
    off = inner.join(child, ["tree", "left"]).join(other, ["tree", "right"]).where("abs(weight - lw - rw) > 1e-6")
    assert off.count() == 0


def test_fold_predictions_cover_every_row(spark):
    rows = spark.range(600).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"),
                                   F.when(F.col("id") % 7 > 3, "a").otherwise("b").alias("t"))
    stages = [features.index_categories(["t"], ["label"]), features.assemble(["x"]), models.forest_classifier(num_trees=3, max_depth=2)]
    grid = {"numTrees": [2, 3], "maxDepth": [1, 2]}
    found = models.fold_predictions(stages, rows, grid, "k", folds=3)
    assert found.count() == 600 * 4 and found.select("key", "point").distinct().count() == 2400
    assert found.groupBy("key").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    table, best = models.cross_validate(stages, rows, grid, "k", folds=3)
    expected = {}
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    for p in range(4):
        values = [evaluator.evaluate(found.where(f"point = {p} AND fold = {f}")) for f in range(3)]
        expected[p] = sum(values) / 3
    assert [r["value"] for r in table.collect()] == pytest.approx([expected[p] for p in range(4)])
    assert best.stages[-1].getNumTrees in (2, 3)
    with pytest.raises(ValueError):
        models.cross_validate(stages, rows, grid, "k", metric="unheard")


def test_fits_of_a_search_do_not_shuffle(spark, monkeypatch):
    plans = []
    from pyspark.ml.classification import RandomForestClassifier
    fit = RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, params=None: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), fit(self, df, params))[1])
    rows = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("x"),
                                   (F.col("id") % 2).cast("double").alias("label"))
    models.fold_predictions([features.assemble(["x"]), models.forest_classifier(num_trees=2, max_depth=1)], rows,
                            {"maxDepth": [1, 2]}, "k", folds=2)
    # the exchange lies below the persisted rows, which are filled before the first fit
    assert len(plans) == 4 and all("InMemoryTableScan" in p.split("InMemoryRelation")[0] for p in plans)


def test_rows_follow_branches_not_a_lookup_per_step(spark, sf_dir):
    run = catalog.fitted(spark, sf_dir, "1a")
    nodes = run.nodes()
    assert nodes.where("categories IS NOT NULL").count() and nodes.where("threshold IS NOT NULL").count()
    rows = model_store.score_with_nodes(run.scored, nodes, 5, classify=True)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # a step used to look up its node among the tree's, several times a row
    assert "element_at" not in plan and "CASE WHEN" in plan
    assert rows.where("NOT prediction <=> node_prediction").count() == 0
    # a walk that ends early answers from the node it has reached
    root = model_store.score_with_nodes(run.scored, nodes, 0, classify=True)
    assert root.select("node_prediction").distinct().count() == 1


def _seen_by_fits(monkeypatch):
    """What each forest fit is given: frame, storage level, partitions' sizes."""
    from pyspark.ml.classification import RandomForestClassifier
    seen, fit = [], RandomForestClassifier.fit

    def spy(self, df, params=None):
        seen.append((df, df.storageLevel, df.groupBy(F.spark_partition_id()).count().toPandas()["count"].tolist()))
        return fit(self, df, params)
    monkeypatch.setattr(RandomForestClassifier, "fit", spy)
    return seen


def test_partitions_of_a_fit_do_not_grow_with_its_rows(spark, monkeypatch):
    # a third of the rows has one key
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
                                    (F.col("id") % 1009).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    stages = [features.assemble(["x"]), models.forest_classifier(num_trees=2, max_depth=1)]
    seen = _seen_by_fits(monkeypatch)
    models.train(stages, rows, "k")
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    models.train(stages, rows, "k")
    models.train(stages, rows, "k", partitions=8)
    (_, level, few), (_, _, many), (_, _, given) = seen
    assert level.useDisk and not level.useMemory  # the memory is for the learner's own rows
    assert len(few) <= 32 and max(few) > 3000 and len(given) <= 8
    assert len(many) > 64 and max(many) < 400 and sum(few) == sum(many) == sum(given) == 9000


def test_large_searches_fit_fold_by_fold(spark, monkeypatch):
    rows = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("x"),
                                   (F.col("id") % 2).cast("double").alias("label"))
    stages = [features.assemble(["x"]), models.forest_classifier(num_trees=2, max_depth=1)]
    ask = lambda: models.fold_predictions(stages, rows, {"maxDepth": [1, 2]}, "k", folds=3)
    usual = ask().orderBy("key", "point").collect()
    monkeypatch.setattr(models, "HELD_ROWS", 299)
    seen = _seen_by_fits(monkeypatch)
    assert ask().orderBy("key", "point").collect() == usual
    frames = [id(df) for df, _, _ in seen]
    assert frames == sorted(frames, key=frames.index) and len(set(frames)) == 3  # no fold begins before the last one ends


def test_held_rows_are_encoded_once_for_all_points(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassificationModel
    scored, score = [], RandomForestClassificationModel.transform
    monkeypatch.setattr(RandomForestClassificationModel, "transform",
                        lambda self, df, params=None: (scored.append(df.columns), score(self, df, params))[1])
    rows = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("x"),
                                   (F.col("id") % 2).cast("double").alias("label"))
    stages = [features.assemble(["x"]), models.forest_classifier(num_trees=2, max_depth=1)]
    found = models.fold_predictions(stages, rows, {"maxDepth": [1, 2], "numTrees": [1, 2]}, "k", folds=2)
    assert found.count() == 1200 and found.select("key", "point").distinct().count() == 1200
    # each point's answers are added to the same rows, which are read once
    assert sorted(len(columns) for columns in scored) == [3, 3, 4, 4, 5, 5, 6, 6]


def _shape(model):
    """Every node of every tree; a 0/1 slot's threshold and its set read alike."""
    def walk(node, out):
        inner = node.numDescendants() > 0
        split = node.split() if inner else None
        kind = split.getClass().getSimpleName() if inner else ""
        at = split.threshold() if kind == "ContinuousSplit" else 0.5 if inner and list(split.leftCategories()) == [0.0] else None
        out.append((split.featureIndex(), at, round(node.gain(), 12)) if inner else node.prediction())
        if inner:
            walk(node.leftChild(), out)
            walk(node.rightChild(), out)
        return out
    return [walk(t._java_obj.rootNode(), []) for t in model.stages[-1].trees]


def test_binary_slots_split_as_numbers_give_the_same_trees(spark, monkeypatch):
    rows = spark.range(30000).select(
        F.col("id").alias("k"), (F.col("id") * 7919 % 12).cast("string").alias("a"), (F.col("id") * 31 % 40).cast("string").alias("b"),
        F.when(F.col("id") % 10007 == 5, "rare").otherwise((F.col("id") % 3).cast("string")).alias("d"),
        (F.col("id") % 101).cast("double").alias("x"),
        F.element_at(F.array(F.lit("p"), F.lit("q"), F.lit("r")), ((F.col("id") * 7919 % 12 + F.col("id") * 31 % 40 + F.col("id") % 4) % 3 + 1).cast("int")).alias("t"))
    cats = ["a", "b", "d"]
    stages = [features.index_categories([*cats, "t"], [*[x + "_i" for x in cats], "label"]),
              features.one_hot([x + "_i" for x in cats], [x + "_o" for x in cats]),
              features.assemble([*[x + "_o" for x in cats], "x"]), models.forest_classifier(num_trees=8, max_depth=4)]
    found = models.train(stages, rows, "k", partitions=8)
    kinds = {s.getClass().getSimpleName() for t in found.stages[-1].trees for s in [t._java_obj.rootNode().split()]}
    assert kinds == {"ContinuousSplit"}
    monkeypatch.setattr(models, "SAMPLED", float("inf"))
    assert _shape(models.train(stages, rows, "k", partitions=8)) == _shape(found)


def test_rare_binary_slots_stay_binary(spark):
    rows = spark.range(30000).select((F.col("id") % 2).cast("string").alias("a"), F.when(F.col("id") < 20, "r").otherwise("s").alias("b"),
                                     (F.col("id") % 3).cast("double").alias("label"))
    stages = [features.index_categories(["a", "b"]), features.one_hot(["a_idx", "b_idx"], ["a_o", "b_o"], drop_last=False),
              features.assemble(["a_o", "b_o"])]
    df = Pipeline(stages=stages).fit(rows).transform(rows).select("label", "features")
    attrs = models.split_at_half(df, models.forest_classifier()).schema["features"].metadata["ml_attr"]["attrs"]
    names = {kind: {x["name"] for x in group} for kind, group in attrs.items()}
    # a slot of 20 in 30,000 rows may be missing in a sample of 10,000; one that no row has is never split
    assert {"b_o_r", "b_o_s"} <= names["binary"] and {"a_o_0", "a_o_1"} <= names["numeric"]
    assert models.split_at_half(df, models.tree_regressor("label")) is df
