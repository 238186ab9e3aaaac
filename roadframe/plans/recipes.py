"""The seven model recipes, as data, and the code that runs one.

A recipe names its label, its categorical and numeric inputs, how the
categories are encoded, the assembler order, the split and the estimator.
``run_recipe`` turns that into: optional dedup -> column selection and
null drop -> stored model input -> split -> Spark ML pipeline fit ->
scoring -> metrics frame.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

import pyspark
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe.operators import dedup, evaluate, features, model_store, models, splits
from roadframe.operators import transforms as T
from roadframe.plans.cleaning import add_main_reason


@dataclass(frozen=True)
class Recipe:
    name: str
    label: str
    task: str                     # "classify" or "regress"
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    encode: str                   # "onehot" or "index"
    index_invalid: str            # indexer mode for categorical inputs
    assembler_invalid: str        # "error" or "skip"
    numeric_first: bool           # assembler order: numeric then categorical
    estimator: str                # "forest_classifier", "forest_regressor", "tree_regressor"
    estimator_params: tuple = ()  # given as a dict, kept as sorted (name, value) pairs
    dedup: bool = False           # one row per crash id before the split
    select_and_dropna: bool = False
    weights: tuple[float, ...] = (0.8, 0.2)
    seed: int = 42
    assembler_order: tuple[str, ...] | None = None  # explicit feature order (base column names)

    def __post_init__(self):
        # immutable pairs: the shared RECIPES entries cannot be changed in place,
        # and recipes stay hashable and picklable
        params = self.estimator_params
        pairs = params.items() if isinstance(params, Mapping) else params
        object.__setattr__(self, "estimator_params", tuple(sorted(pairs)))

    @property
    def metrics(self) -> tuple[str, ...]:
        return ("accuracy",) if self.task == "classify" else ("rmse", "r2")


# Labels, input columns and their order, encodings, splits and
# learner parameters decide the results.
# Recipes 1-2 exist in two forms ("a": dedup, index-only categories, 70/30;
# "b": no dedup, one-hot, 80/20); 3-5 have one form.
RECIPES: dict[str, Recipe] = {
    "1a": Recipe(
        name="1a", label="time_segment", task="classify",
        categorical=("borough", "factor_v1"),
        numeric=("total_cars", "month", "zip_code", "day_of_week", "total_injured", "total_killed"),
        encode="index", index_invalid="keep", assembler_invalid="error", numeric_first=False,
        estimator="forest_classifier", estimator_params={"num_trees": 100, "max_depth": 5},
        dedup=True, select_and_dropna=True, weights=(0.7, 0.3),
        assembler_order=("borough", "total_cars", "month", "zip_code", "day_of_week",
                         "total_injured", "total_killed", "factor_v1"),
    ),
    "1b": Recipe(
        name="1b", label="time_segment", task="classify",
        categorical=("borough", "total_cars", "factor_v1"),
        numeric=("month", "zip_code", "day_of_week", "total_injured", "total_killed"),
        encode="onehot", index_invalid="keep", assembler_invalid="skip", numeric_first=False,
        estimator="forest_classifier", estimator_params={"num_trees": 100},
    ),
    "2a": Recipe(
        name="2a", label="borough", task="classify",
        categorical=("time_segment", "factor_v1"),
        numeric=("total_cars", "year", "month", "day_of_week", "total_injured", "total_killed"),
        encode="index", index_invalid="keep", assembler_invalid="error", numeric_first=False,
        estimator="forest_classifier", estimator_params={"num_trees": 100, "max_depth": 5},
        dedup=True, select_and_dropna=True, weights=(0.7, 0.3),
        assembler_order=("time_segment", "total_cars", "year", "month", "day_of_week",
                         "total_injured", "total_killed", "factor_v1"),
    ),
    "2b": Recipe(
        name="2b", label="borough", task="classify",
        categorical=("time_segment", "factor_v1"),
        numeric=("total_cars", "year", "month", "day_of_week", "total_injured", "total_killed"),
        encode="onehot", index_invalid="keep", assembler_invalid="skip", numeric_first=False,
        estimator="forest_classifier", estimator_params={"num_trees": 100},
    ),
    "3": Recipe(
        name="3", label="main_reason", task="classify",
        categorical=("borough", "zip_code", "year", "month", "day_of_week", "time_segment"),
        numeric=("total_injured", "total_killed", "fatality_rate", "total_cars"),
        encode="onehot", index_invalid="keep", assembler_invalid="skip", numeric_first=False,
        estimator="forest_classifier", estimator_params={"num_trees": 100},
    ),
    "4": Recipe(
        name="4", label="total_injured", task="regress",
        categorical=("borough", "time_segment", "day_of_week"),
        numeric=("total_cars", "total_killed", "fatality_rate", "year"),
        encode="onehot", index_invalid="error", assembler_invalid="error", numeric_first=True,
        estimator="forest_regressor", estimator_params={"max_depth": 5, "max_bins": 10},
    ),
    "5": Recipe(
        name="5", label="total_cars", task="regress",
        categorical=("borough", "time_segment", "day_of_week"),
        numeric=("total_killed", "total_injured", "fatality_rate", "year"),
        encode="onehot", index_invalid="error", assembler_invalid="error", numeric_first=True,
        estimator="tree_regressor", estimator_params={"max_depth": 5, "max_bins": 10},
    ),
}

KEY = "crash_id"


def model_input(clean: DataFrame, recipe: Recipe) -> DataFrame:
    """The rows and columns a recipe trains on: key, label and inputs only
    (the key is kept for the split)."""
    df = clean
    if recipe.label == "main_reason" and "main_reason" not in df.columns:
        df = add_main_reason(df)
    cols = [KEY, recipe.label, *recipe.categorical, *recipe.numeric]
    df = df.select(*cols)
    if recipe.dedup:
        # one row per crash id, the smallest by its values, so that a retried
        # task cannot change what the fit sees
        df = dedup.dedup_by_key(df, [KEY], order_by=cols[1:])
    if recipe.select_and_dropna:
        df = T.drop_incomplete(df)
    return df


def split(df: DataFrame, recipe: Recipe, method: str = "stable") -> list[DataFrame]:
    """Train / test parts: ``stable`` hashes the crash id (no sort, same
    result for any layout, duplicates of one crash stay on one side);
    ``random`` is Spark's seeded Bernoulli split."""
    if method == "random":
        return splits.random_split(df, recipe.weights, recipe.seed)
    return splits.stable_split(df, recipe.weights, [KEY], seed=recipe.seed)


def stages(recipe: Recipe) -> tuple[list, str]:
    """Pipeline stages for a recipe, and the label column it predicts."""
    cat = list(recipe.categorical)
    idx = [col + "_idx" for col in cat]
    stage_list: list = []
    # one scan indexes the inputs and, where both keep unseen values, the label
    classify = recipe.task == "classify"
    together = classify and recipe.index_invalid == "keep"
    if cat:
        extra = ([recipe.label], ["label"]) if together else ([], [])
        stage_list.append(features.index_categories(cat + extra[0], idx + extra[1], invalid=recipe.index_invalid))
    if recipe.encode == "onehot" and cat:
        enc = [col + "_ohe" for col in cat]
        stage_list.append(features.one_hot(idx, enc))
        cat_out = dict(zip(cat, enc))
    else:
        cat_out = dict(zip(cat, idx))
    label_col = recipe.label
    if classify:
        if not (cat and together):
            stage_list.append(features.index_categories([recipe.label], ["label"], invalid="keep"))
        label_col = "label"
    if recipe.assembler_order:
        inputs = [cat_out.get(col, col) for col in recipe.assembler_order]
    elif recipe.numeric_first:
        inputs = [*recipe.numeric, *cat_out.values()]
    else:
        inputs = [*cat_out.values(), *recipe.numeric]
    stage_list.append(features.assemble(inputs, "features", invalid=recipe.assembler_invalid))
    builder = getattr(models, recipe.estimator)
    stage_list.append(builder(label=label_col, **dict(recipe.estimator_params), seed=recipe.seed))
    return stage_list, label_col


@dataclass
class RecipeRun:
    recipe: Recipe
    model: object
    train: DataFrame
    test: DataFrame
    scored: DataFrame
    label_col: str
    model_path: str | None = None  # where the fit is stored, if it is

    def nodes(self) -> DataFrame:
        """The trees of a stored fit as a table (``model_store.node_table``)."""
        if self.model_path is None:
            raise ValueError("only a stored fit has a node table; use stored_run")
        return model_store.node_table(self.scored.sparkSession, self.model_path, self.model)

    def metrics(self, digits: int | None = None) -> DataFrame:
        return recipe_metrics(self.recipe, self.scored, self.label_col, digits)

    def predictions(self) -> DataFrame:
        """Key, label text / value, indexed label (classification) and prediction."""
        cols = [KEY, self.recipe.label] + ([self.label_col] if self.label_col != self.recipe.label else [])
        return self.scored.select(*cols, "prediction")

    def label_list(self) -> list[str] | None:
        """Label texts in index order (classification recipes only)."""
        if self.recipe.task != "classify":
            return None
        for stage in self.model.stages:
            if isinstance(stage, StringIndexerModel) and "label" in stage.getOutputCols():
                return list(stage.labelsArray[stage.getOutputCols().index("label")])
        raise LookupError("no label indexer in the fitted pipeline")


def recipe_metrics(recipe: Recipe, scored: DataFrame, label_col: str,
                   digits: int | None = None) -> DataFrame:
    """``(model, metric, value)`` of scored rows: accuracy for classifiers,
    RMSE and R2 for regressors."""
    if recipe.task == "classify":
        out = evaluate.classification_metrics(scored, label_col, digits=digits)
    else:
        out = evaluate.regression_metrics(scored, label_col, digits=digits)
    return out.select(F.lit(recipe.name).alias("model"), "metric", "value")


def run_recipe(clean: DataFrame, recipe: Recipe | str, split_method: str = "stable",
               materialize: bool = True, work_path: str | None = None,
               partitions: int | None = None) -> RecipeRun:
    """Fit a recipe on its training part and score its test part. The learner
    sees its rows in ``partitions`` hash partitions (by default as many as
    ``models.fit_partitions`` gives for their number).

    The recipe's model input (key, label and inputs only) is stored once as a
    table (at ``work_path``, overwritten, or a new scratch folder below the
    shared checkpoint folder), so the raw data and the cleaning run once per
    recipe, not once per part, and every fit pass scans the narrow table.
    With the stable split the stored table carries each row's split part as
    a column, so later passes select a part with an int comparison instead
    of hashing every key again (a ``partitionBy`` would add a sort to the
    write).
    A random split needs the stored input in any case: its two parts are
    evaluated separately and must see the same rows in the same layout."""
    recipe = RECIPES[recipe] if isinstance(recipe, str) else recipe
    df = model_input(clean, recipe)
    if split_method == "stable" and materialize:
        parted = splits.with_split_part(df, recipe.weights, [KEY], seed=recipe.seed, out="_part")
        stored = models.materialize(parted, f"input-{recipe.name}", path=work_path)
        train_df, test_df = [stored.where(F.col("_part") == i).drop("_part") for i in (0, 1)]
    else:
        if materialize or split_method == "random":
            df = models.materialize(df, f"input-{recipe.name}", path=work_path)
        train_df, test_df = split(df, recipe, split_method)
    stage_list, label_col = stages(recipe)
    fitted = models.train(stage_list, train_df, KEY, partitions)
    scored = models.score(fitted, test_df)
    return RecipeRun(recipe, fitted, train_df, test_df, scored, label_col)


def stored_run(clean: DataFrame, recipe: Recipe | str, source: DataFrame | None = None,
               partitions: int | None = None) -> RecipeRun:
    """``run_recipe`` with the stable split, fitted once per input and recipe.

    The model and its input are stored under a fingerprint of the recipe, the
    partitions, Spark's version and the input, and loaded when asked for
    again. ``source`` is the frame, read straight from files, that ``clean``
    comes from: its files identify the input without a pass over the data.
    Without it the rows of the model input are hashed. Change the recipe (or
    its name) when the cleaning changes: its code is no part of the key."""
    recipe = RECIPES[recipe] if isinstance(recipe, str) else recipe
    spark = clean.sparkSession
    seen = model_store.source_fingerprint(source) if source is not None \
        else model_store.content_fingerprint(model_input(clean, recipe))
    layout = partitions or [models.FIT_PARTITIONS, models.FIT_ROWS]
    key = model_store.fingerprint(asdict(recipe), layout, pyspark.__version__, seen)
    folder = model_store.find(spark, key)
    if folder is None:
        attempt = model_store.new_folder(spark, key)
        run = run_recipe(clean, recipe, work_path=f"{attempt}/input", partitions=partitions)
        run.model.write().save(f"{attempt}/model")
        folder = model_store.finish(spark, key, attempt)
        if folder == attempt:
            run.model_path = f"{folder}/model"
            return run
    fitted = PipelineModel.load(f"{folder}/model")
    stored = spark.read.parquet(f"{folder}/input")
    train_df, test_df = [stored.where(F.col("_part") == i).drop("_part") for i in (0, 1)]
    return RecipeRun(recipe, fitted, train_df, test_df, models.score(fitted, test_df), stages(recipe)[1], f"{folder}/model")
