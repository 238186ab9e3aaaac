"""Tree-ensemble estimators, fitting, scoring, importances and
cross-validation, all on Spark ML.

Tree learning is Spark's own: executors aggregate split statistics over
binned rows and pick each node's best split; the driver only grows the
trees, so it holds the model, never the data. Seeds are always set and the
rows are laid out by key, so a fit repeats for any cores and input files.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.functions.columns import c
from roadframe.operators.splits import split_bucket
from roadframe.session import fresh_shared_path
from roadframe.sources.delimited import preview

# Scale settings shared by all tree learners. A larger histogram budget
# lets one pass over the data serve more nodes per tree level (fewer
# passes for wide one-hot inputs). Node-id caching stays off: it stores
# one id per row and tree (100 per row for a 100-tree forest) and pays off
# only for deep trees, not depth 5; pass ``cacheNodeIds=True`` (with the
# checkpoint interval below) for deep trees.
TREE_SCALE_PARAMS = {"cacheNodeIds": False, "checkpointInterval": 10, "maxMemoryInMB": 512}


def forest_classifier(label: str = "label", features: str = "features", num_trees: int = 100,
                      max_depth: int = 5, seed: int = 42, **params) -> RandomForestClassifier:
    """Random-forest classifier (100 trees, depth 5 by default)."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, **{**TREE_SCALE_PARAMS, **params})


def forest_regressor(label: str, features: str = "features", num_trees: int = 20, max_depth: int = 5,
                     max_bins: int = 10, seed: int = 42, **params) -> RandomForestRegressor:
    """Random-forest regressor (20 trees, depth 5, 10 bins by default)."""
    return RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=num_trees,
                                 maxDepth=max_depth, maxBins=max_bins, seed=seed,
                                 **{**TREE_SCALE_PARAMS, **params})


def tree_regressor(label: str, features: str = "features", max_depth: int = 5, max_bins: int = 10,
                   seed: int = 42, **params) -> DecisionTreeRegressor:
    """Single decision-tree regressor (depth 5, 10 bins by default)."""
    return DecisionTreeRegressor(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                 maxBins=max_bins, seed=seed, **{**TREE_SCALE_PARAMS, **params})


# Partitions that a learner's rows are dealt to, and the rows of one from which
# on there are more of them. Spark ML holds each row's binned slots and its draws
# for all trees (1.7 KB a row for a 100-tree forest over 310 slots); a task
# builds one partition of them at a time, so its size must not grow with the
# input. Bagging draws by partition and row order, so the rows, their number,
# the key and the seed decide the trees; the cores and the input files do not.
FIT_PARTITIONS = 32
FIT_ROWS = 150_000
# Folds of a search that are fitted at the same time, and the rows they may
# hold together (memory and disk); large inputs are fitted fold by fold.
FOLDS_AT_ONCE = 5
HELD_ROWS = 20_000_000
# Expected rows of a 0/1 slot's rarer value in Spark ML's sample of the rows,
# from which on the slot may be split as a number.
SAMPLED = 20


def fit_partitions(rows: int) -> int:
    """Partitions for a fit on ``rows`` rows."""
    return max(FIT_PARTITIONS, -(-rows // FIT_ROWS))


def materialize(df: DataFrame, name: str = "model-input", path: str | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet and read it back: later passes (indexer fit,
    split search, tree levels) scan this narrow table instead of recomputing
    the whole lineage, and a lost executor costs a re-read, not a recompute
    from the source. ``path`` (overwritten) defaults to a new folder below
    the shared checkpoint folder. ``partition_by`` writes one folder per
    value, so a filter on those columns prunes whole folders."""
    path = path or fresh_shared_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # also for an empty table


def laid_out(df: DataFrame, key: str, order_by: Sequence[str], partitions: int = FIT_PARTITIONS) -> DataFrame:
    """``df`` in a layout that depends on its rows alone: hash partitions of
    ``key``, each sorted by ``key`` and ``order_by`` (rows that tie on all of
    these must be alike). Beyond ``FIT_PARTITIONS`` the hash takes all of these
    columns, so that the rows of a frequent key do not meet in one partition."""
    keys = [c(x) for x in dict.fromkeys([key, *order_by])]
    return df.repartition(partitions, *keys[:len(keys) if partitions > FIT_PARTITIONS else 1]).sortWithinPartitions(*keys)


def split_at_half(rows: DataFrame, learner) -> DataFrame:
    """``rows`` (label and vector) for a forest classifier, with the frequent
    0/1 slots declared numeric. For more than two labels Spark ML tests every
    split of a binary slot through a set of categories, for each row, tree and
    level; a number's bin is only counted. Both give the one split between 0 and
    1, so the trees are the same, with a threshold for the set.

    A number's splits come from a sample of the rows, so only slots whose rarer
    value is expected ``SAMPLED`` times in it change (missed by chance: e^-20);
    the rare ones stay binary. Their counts take one pass."""
    name = learner.getFeaturesCol()
    metadata = json.loads(json.dumps(rows.schema[name].metadata))  # a copy
    attrs = metadata.get("ml_attr", {}).get("attrs", {})
    if not isinstance(learner, RandomForestClassifier) or not attrs.get("binary"):
        return rows
    found = rows.select(Summarizer.metrics("count", "numNonZeros").summary(F.col(name)).alias("s")).first()["s"]
    n, ones = found["count"], found["numNonZeros"]
    if not n:
        return rows
    share = min(1.0, max(learner.getMaxBins() ** 2, 10_000) / n)  # Spark ML's sample
    often = [x for x in attrs["binary"] if min(ones[x["idx"]], n - ones[x["idx"]]) * share >= SAMPLED]
    rare = [x for x in attrs["binary"] if x not in often]
    kept = {kind: group for kind, group in attrs.items() if kind not in ("binary", "numeric")}
    numeric = [*attrs.get("numeric", []), *({k: v for k, v in x.items() if k in ("idx", "name")} for x in often)]
    metadata["ml_attr"]["attrs"] = {**kept, **({"numeric": numeric} if numeric else {}), **({"binary": rare} if rare else {})}
    return rows.select(learner.getLabelCol(), F.col(name).alias(name, metadata=metadata))


def train(stages: Sequence, train_df: DataFrame, key: str | None = None,
          partitions: int | None = None) -> PipelineModel:
    """Chain the stages and fit them once on ``train_df``. With ``key``, the
    last stage (the learner) is fitted on the rows laid out by it, so the fit
    is the same for any cores and input files; ``partitions`` follows from
    their number when it is not given. The laid-out vectors are persisted for
    the time of the fit, as each of the learner's first passes would shuffle and
    sort them anew: on disk, as the memory is for the binned rows that Spark ML
    holds itself and passes over once a tree level."""
    if key is None:
        return Pipeline(stages=list(stages)).fit(train_df)
    prepared, learner = Pipeline(stages=list(stages[:-1])).fit(train_df), stages[-1]
    rows = laid_out(train_df, key, train_df.columns, partitions or fit_partitions(train_df.count()))
    rows = prepared.transform(rows).select(learner.getLabelCol(), learner.getFeaturesCol()).persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel(stages=[*prepared.stages, learner.fit(split_at_half(rows, learner))])
    finally:
        rows.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a fitted pipeline (a per-row projection; no job runs here)."""
    return model.transform(df)


def prediction_pairs(predictions: DataFrame, label: str, labels: Sequence[str] | None = None,
                     n: int = 10, order_by: Sequence[str] | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Actual vs predicted values for ``n`` rows (the top ``n`` by
    ``order_by`` when given). With ``labels`` (the label indexer's list) the
    predicted index is also turned back into label text, after the top ``n``
    is taken, so the conversion runs on ``n`` rows only."""
    cols = [*dict.fromkeys([*keep, *(order_by or []), label, "prediction"])]
    top = preview(predictions.select(*[c(x) for x in cols]), n, order_by)
    top = top.select(*[c(x) for x in [*keep, label, "prediction"]])
    if labels is not None:
        top = IndexToString(inputCol="prediction", outputCol="predicted_label",
                            labels=list(labels)).transform(top)
    return top


def slot_names(scored: DataFrame, width: int, features: str = "features") -> list[str]:
    """Names of the feature vector's slots, from its attribute metadata
    (one-hot slots read as ``column_value``)."""
    meta = scored.schema[features].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for attr in group:
            names[attr["idx"]] = attr.get("name", f"f{attr['idx']}")
    return [names.get(i, f"f{i}") for i in range(width)]


def feature_importance(spark: SparkSession, model: PipelineModel, scored: DataFrame,
                       features: str = "features") -> DataFrame:
    """``(feature, importance)`` of the final tree stage, one row per vector
    slot, named by ``slot_names``."""
    importances = model.stages[-1].featureImportances.toArray()
    names = slot_names(scored, len(importances), features)
    rows = [(name, float(v)) for name, v in zip(names, importances)]
    return spark.createDataFrame(rows, "feature string, importance double")


def cross_validate(stages: Sequence, train_df: DataFrame, grid: Mapping[str, Sequence], key: str,
                   label: str = "label", metric: str = "accuracy", folds: int = 5, seed: int = 42,
                   parallelism: int = 4, partitions: int | None = None) -> tuple[DataFrame, PipelineModel]:
    """Grid search over the last stage's params with k-fold cross-validation:
    ``(params, metric, value)`` per grid point, the average over folds, and
    the pipeline of the best point (the first of equals) fitted on all rows.

    ``fold_predictions`` holds the search; the averages are taken over its
    stored predictions in one aggregation."""
    if metric not in FOLD_METRICS:
        raise ValueError(f"metric must be one of {sorted(FOLD_METRICS)}")
    spark, stages = train_df.sparkSession, list(stages)
    maps = _grid(stages[-1], grid)
    predictions = fold_predictions(stages, train_df, grid, key, label, folds, seed, parallelism, partitions)
    values, largest = FOLD_METRICS[metric]
    by_fold = predictions.groupBy("point", "fold").agg(values().alias("value"))
    found = by_fold.groupBy("point").agg(F.avg("value").alias("value")).orderBy("point").collect()  # one per grid point
    means = {r["point"]: r["value"] for r in found}
    best = (max if largest else min)(sorted(means), key=means.get)
    table = spark.createDataFrame([(_described(m), metric, float(means[i])) for i, m in enumerate(maps)],
                                  "params string, metric string, value double")
    return table, train([*stages[:-1], stages[-1].copy(maps[best])], train_df, key, partitions)


def _squares():
    return (F.col("label") - F.col("prediction")) ** 2


#: metric of stored predictions, and whether the largest is best
FOLD_METRICS = {
    "accuracy": (lambda: F.avg((F.col("label") == F.col("prediction")).cast("double")), True),
    "rmse": (lambda: F.sqrt(F.avg(_squares())), False),
    "mse": (lambda: F.avg(_squares()), False),
    "mae": (lambda: F.avg(F.abs(F.col("label") - F.col("prediction"))), False),
    "r2": (lambda: 1 - F.try_divide(F.sum(_squares()), F.var_pop("label") * F.count(F.lit(1))), True),
}


def _grid(learner, grid: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(learner.getParam(name), list(values))
    return builder.build()


def _described(point: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))


def fold_predictions(stages: Sequence, train_df: DataFrame, grid: Mapping[str, Sequence], key: str,
                     label: str = "label", folds: int = 5, seed: int = 42, parallelism: int = 4,
                     partitions: int | None = None) -> DataFrame:
    """``(key, label, prediction, point, fold)``, stored: every row of
    ``train_df`` scored, for each grid point, by the fit on the other folds.

    Folds are md5 buckets of ``key``, stored with the rows. The feature stages
    are fitted once per fold; the training vectors, laid out for the learner,
    are persisted (memory and disk) for the time of the fold's fits, so that no
    fit shuffles. ``parallelism`` fits run at a time. The held rows are read
    and encoded once and scored by all of the fold's fits."""
    spark, stages = train_df.sparkSession, list(stages)
    learner = stages[-1]
    maps = _grid(learner, grid)
    path = fresh_shared_path(spark, "fold-predictions")
    stored = materialize(train_df.withColumn("_fold", split_bucket([key], f"fold-{seed}", folds)), "fold-input")
    n = stored.count()

    def one(fold: int) -> None:
        training, held = [stored.where(part).drop("_fold") for part in (F.col("_fold") != fold, F.col("_fold") == fold)]
        prepared = Pipeline(stages=stages[:-1]).fit(training)
        rows = prepared.transform(laid_out(training, key, train_df.columns, partitions or fit_partitions(n)))
        rows = rows.select(label, learner.getFeaturesCol()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows.count()
            fits = pool.map(lambda m: learner.fit(rows, m), maps)
        finally:
            rows.unpersist()
        kept = [c(key).alias("key"), c(label).cast("double").alias("label")]
        scored = prepared.transform(held).select(*kept, c(learner.getFeaturesCol()).alias("_features"))
        for i, fit in enumerate(fits):
            fit = fit.copy().setFeaturesCol("_features").setPredictionCol("prediction")
            scored = fit.transform(scored).select("key", "label", "_features", *[f"_{j}" for j in range(i)],
                                                  F.col("prediction").alias(f"_{i}"))
        each = F.explode(F.array(*[F.struct(F.col(f"_{i}").alias("prediction"), F.lit(i).alias("point")) for i in range(len(fits))]))
        found = scored.select("key", "label", each.alias("at")).select("key", "label", "at.*")
        found.withColumn("fold", F.lit(fold)).write.parquet(f"{path}/{fold}")

    at_once = min(folds, FOLDS_AT_ONCE, max(1, HELD_ROWS // max(n, 1)))
    with ThreadPool(parallelism) as pool, ThreadPool(at_once) as outer:
        outer.map(one, range(folds))
    # a folder for each fold: writers at the same time must not share one
    return spark.read.parquet(*[f"{path}/{fold}" for fold in range(folds)])
