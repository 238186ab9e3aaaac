"""Fitted pipelines kept in the shared folder, and their trees as tables.

A fit is stored under a fingerprint of what decides it: the input, the recipe
and its parameters. Whoever asks for the same fit again, in this application
or another one that uses the folder, loads it. A learner's trees are read
from the stored model as a node table, which SQL can join, sum and score with.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.functions.columns import c
from roadframe.operators import features
from roadframe.session import path_exists, shared_path

FOLDER = "roadframe-models"


def _hash_sums(df: DataFrame) -> list:
    """Count, sum and exclusive or of the rows' hashes: the same for any order."""
    row = F.xxhash64(*[c(name) for name in df.columns])
    sums = df.select(row.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"),
                                         F.bit_xor("h").alias("x")).first()
    return [sums["n"], str(sums["s"]), sums["x"]]


def source_fingerprint(source: DataFrame) -> list:
    """What identifies the files a frame was read from: the path, length and
    change time of each. Reads no data columns."""
    return _hash_sums(source.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct())


def content_fingerprint(df: DataFrame) -> list:
    """What identifies the rows of any frame; one pass over it."""
    return [df.schema.simpleString(), *_hash_sums(df)]


def fingerprint(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=repr).encode()).hexdigest()[:32]


def find(spark: SparkSession, key: str) -> str | None:
    """Folder of the finished fit stored under ``key``."""
    done = shared_path(spark, FOLDER, key, "done")
    if not path_exists(spark, f"{done}/_SUCCESS"):
        return None
    return spark.read.schema("folder string").parquet(done).first()["folder"]


def new_folder(spark: SparkSession, key: str) -> str:
    """An unused folder for a fit to be stored under ``key``: attempts that
    fail or run side by side do not meet."""
    return shared_path(spark, FOLDER, key, uuid.uuid4().hex[:12])


def finish(spark: SparkSession, key: str, folder: str) -> str:
    """Mark the fit in ``folder`` as the one of ``key`` (the first one stays)."""
    marker = spark.createDataFrame([(folder,)], "folder string").coalesce(1)
    marker.write.mode("ignore").parquet(shared_path(spark, FOLDER, key, "done"))
    return find(spark, key) or folder


def node_table(spark: SparkSession, path: str, model: PipelineModel) -> DataFrame:
    """The trees of the last stage of the pipeline stored at ``path``: one row
    per node, ``(tree, node, feature, threshold, categories, gain, rows,
    weight, left, right, prediction, stats)``.

    ``feature`` is the slot of the feature vector, null for a leaf. A numeric
    split sends values up to ``threshold`` left, a categorical one those in
    ``categories``. ``stats`` are the label counts of a classifier, and count,
    sum and sum of squares of a regressor's label; ``weight`` is their count.
    """
    learner = model.stages[-1]
    data = spark.read.parquet(f"{path}/stages/*_{learner.uid}/data")
    nodes = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns \
        else data.withColumn("tree", F.lit(0))
    leaf = F.col("leftChild") < 0
    numeric = F.col("split.numCategories") < 0
    counts = F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b) if hasattr(learner, "numClasses") \
        else F.get("impurityStats", F.lit(0))
    inner = lambda col: F.when(~leaf, col)
    return nodes.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").cast("int").alias("node"),
        inner(F.col("split.featureIndex")).cast("int").alias("feature"),
        inner(F.when(numeric, F.get("split.leftCategoriesOrThreshold", F.lit(0)))).alias("threshold"),
        inner(F.when(~numeric, F.col("split.leftCategoriesOrThreshold"))).alias("categories"),
        inner(F.col("gain")).alias("gain"), F.col("rawCount").cast("bigint").alias("rows"), counts.alias("weight"),
        inner(F.col("leftChild")).cast("int").alias("left"), inner(F.col("rightChild")).cast("int").alias("right"),
        "prediction", F.col("impurityStats").alias("stats"))


def importance_from_nodes(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` of every slot: its share of the weighted gain
    of each tree, summed over trees and made to add up to one."""
    spark = nodes.sparkSession
    slots = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "slot int, feature string")  # model's width
    return spark.sql("""
        WITH gains AS (
          SELECT tree, feature AS slot, sum(gain * weight) AS gain FROM {nodes} WHERE feature IS NOT NULL GROUP BY 1, 2
        ), trees AS (SELECT tree, sum(gain) AS gain FROM gains GROUP BY 1 HAVING sum(gain) > 0),
        shares AS (
          SELECT slot, sum(gains.gain / trees.gain) AS share FROM gains JOIN trees ON gains.tree = trees.tree GROUP BY 1
        ), total AS (SELECT sum(share) AS share FROM shares)
        SELECT feature, coalesce(shares.share / total.share, 0D) AS importance
        FROM {slots} s CROSS JOIN total LEFT JOIN shares ON shares.slot = s.slot""", nodes=nodes, slots=slots)


def _branches(tree: dict, at: int, depth: int, places: dict, vector: str) -> str:
    """SQL for the place of the node where a row ends, from node ``at`` down."""
    node = tree[at]
    if depth == 0 or node["left"] is None:
        return str(places[node["tree"], at])
    value = f"get({vector}, {node['feature']})"
    if node["threshold"] is not None:
        to_left = f"{value} <= {node['threshold']!r}D"
    else:
        to_left = f"{value} IN ({', '.join(f'{x!r}D' for x in node['categories']) or 'NULL'})"
    left, right = (_branches(tree, node[side], depth - 1, places, vector) for side in ("left", "right"))
    return f"CASE WHEN {to_left} THEN {left} ELSE {right} END"


def score_with_nodes(rows: DataFrame, nodes: DataFrame, max_depth: int, classify: bool,
                     vector: str = "features", out: str = "node_prediction") -> DataFrame:
    """``rows`` with the answer of the node table: each tree is followed from
    its root, and the leaves' predictions averaged (regression) or their label
    shares summed and the largest taken, the first of equals (classification).

    Each tree becomes one nested CASE over the vector's slots, so a row meets
    only the nodes on its way. The answers of all nodes (model size) are one
    broadcast row; rows are not shuffled."""
    found = nodes.orderBy("tree", "node").collect()  # the model's size
    places = {(n["tree"], n["node"]): i for i, n in enumerate(found)}
    trees: dict[int, dict] = {}
    for n in found:
        trees.setdefault(n["tree"], {})[n["node"]] = n
    # inside a lambda: this many branches are too long for one generated method
    ends = ", ".join(_branches(tree, 0, max_depth, places, "x") for tree in trees.values())
    if classify:
        answers, kind = [[s / n["weight"] for s in n["stats"]] for n in found], "array<array<double>>"
    else:
        answers, kind = [n["prediction"] for n in found], "array<double>"
    table = rows.sparkSession.createDataFrame([(answers,)], f"_answers {kind}")
    joined = rows.withColumn("_x", F.array(features.vector_elements(vector)))
    joined = joined.withColumn("_ends", F.expr(f"get(transform(_x, x -> array({ends})), 0)")).crossJoin(F.broadcast(table))
    if classify:
        none = F.array_repeat(F.lit(0.0), len(answers[0]))
        answer = F.aggregate("_ends", none, lambda a, place: F.zip_with(a, F.get("_answers", place), lambda x, y: x + y),
                             lambda votes: (F.array_position(votes, F.array_max(votes)) - 1).cast("double"))
    else:
        answer = F.aggregate("_ends", F.lit(0.0), lambda a, place: a + F.get("_answers", place)) / F.size("_ends")
    return joined.withColumn(out, answer).drop("_x", "_ends", "_answers")
