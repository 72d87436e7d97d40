"""Fitted trees as MLlib classifiers, so that scoring, saving and loading stay with Spark.

An ensemble is written in the format that MLlib's own models are saved in, metadata and one row per node, and loaded
again. MLlib's log odds are twice the sum of the trees' values, so half of every value is written.
"""

from __future__ import annotations

import json
import time
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession, functions as F

from ..plans import ordered
from .boosting import AdditiveFit, Tree, TreeFit

# Classes and default parameters that MLlib saves with a boosted classifier and its trees.
_CLASSES = ("org.apache.spark.ml.classification.GBTClassificationModel",
            "org.apache.spark.ml.regression.DecisionTreeRegressionModel")
_TREE_DEFAULTS = {
    "cacheNodeIds": False, "checkpointInterval": 10, "featuresCol": "features", "impurity": "variance", "labelCol": "label",
    "leafCol": "", "maxBins": 32, "maxDepth": 30, "maxMemoryInMB": 256, "minInfoGain": 0.0, "minInstancesPerNode": 1,
    "minWeightFractionPerNode": 0.0, "predictionCol": "prediction", "seed": 0}
_DEFAULTS = {**_TREE_DEFAULTS, "featureSubsetStrategy": "all", "lossType": "logistic", "maxIter": 20,
             "probabilityCol": "probability", "rawPredictionCol": "rawPrediction", "stepSize": 0.1, "subsamplingRate": 1.0,
             "validationTol": 0.01}


def _metadata(spark: SparkSession, kind: int, name: str, defaults: dict, **more) -> str:
    return json.dumps({"class": _CLASSES[kind], "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": name,
                       "paramMap": {"featuresCol": "inputs", "labelCol": "label"}, "defaultParamMap": defaults, **more})


def classifier(spark: SparkSession, trees: list[Tree], cuts: list[list[float]]) -> GBTClassificationModel:
    """The sum of `trees`, whose bins end at `cuts`, as a loaded classifier of the column `inputs`."""
    path = f"{ordered.working_folder(spark)}/trees-{uuid4().hex}"
    name = f"GBTClassifier_{uuid4().hex[:12]}"
    number = np.repeat(np.arange(len(trees)), [len(t.left) for t in trees])
    node = np.concatenate([np.arange(len(t.left)) for t in trees])
    feature, cut, left, value, rows, gain = (
        np.concatenate([getattr(t, f) for t in trees]) for f in ("feature", "cut", "left", "value", "rows", "gain"))
    inner = left > 0
    flat = pd.DataFrame({
        "tree": number, "node": node, "prediction": value / 2, "rows": rows,
        "gain": np.where(inner, gain / np.maximum(rows, 1), -1.0), "lower": np.where(inner, left, -1),
        "upper": np.where(inner, left + 1, -1), "feature": np.where(inner, feature, -1),
        "threshold": [cuts[f][c] if i else 0.0 for f, c, i in zip(feature, cut, inner)]})
    count = F.col("rows").cast("double")
    split = F.struct(F.col("feature").alias("featureIndex"), F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(
        F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    schema = ("tree int, node int, prediction double, rows long, gain double, lower int, upper int, feature int, "
              "threshold double")
    data = spark.createDataFrame(flat, schema).select(F.col("tree").alias("treeID"), F.struct(
        F.col("node").alias("id"), "prediction", F.lit(0.0).alias("impurity"),
        F.array(count, F.lit(0.0), count).alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
        F.col("lower").alias("leftChild"), F.col("upper").alias("rightChild"), split.alias("split")).alias("nodeData"))
    data.write.parquet(f"{path}/data")
    each = [(i, _metadata(spark, 1, f"dtr_{i}", _TREE_DEFAULTS), 1.0) for i in range(len(trees))]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    whole = _metadata(spark, 0, name, _DEFAULTS, numFeatures=len(cuts), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTClassificationModel.load(path)


def constant(value: float) -> Tree:
    tree = Tree()
    tree.value[0], tree.rows[0] = value, 1
    return tree


def boosted(spark: SparkSession, fit: TreeFit, names: list[str]) -> GBTClassificationModel:
    return classifier(spark, [constant(fit.base), *fit.trees], [fit.cuts[n] for n in names])


def steps(scores: np.ndarray, axes: list[tuple[int, list[int]]]) -> Tree:
    """A grid of scores as one balanced tree. `axes` names each axis' feature and the bin at which each of its cells ends."""
    tree = Tree()
    tree.rows[0] = 1

    def grow(node: int, part: np.ndarray, offset: list[int]) -> None:
        if (part == part.flat[0]).all():
            tree.value[node] = float(part.flat[0])
            return
        axis = int(np.argmax(part.shape))
        half = part.shape[axis] // 2
        feature, ends = axes[axis]
        left = tree.split(node, feature, ends[offset[axis] + half - 1], 1.0, [(0.0, 1), (0.0, 1)])
        low, high = np.split(part, [half], axis)
        grow(left, low, offset)
        grow(left + 1, high, [o + half * (i == axis) for i, o in enumerate(offset)])

    grow(0, scores, [0] * scores.ndim)
    return tree


def ends(coarse: np.ndarray) -> list[int]:
    """The last bin of every coarse bin but the last."""
    return np.flatnonzero(np.diff(coarse)).tolist()


def additive(spark: SparkSession, fit: AdditiveFit, cuts: list[list[float]]) -> GBTClassificationModel:
    """One tree per term: its step function."""
    trees = [constant(fit.base)]
    trees += [steps(fit.main[i, :len(c) + 1], [(i, list(range(len(c))))]) for i, c in enumerate(cuts)]
    trees += [steps(s, [(a, ends(fit.coarse[a])), (b, ends(fit.coarse[b]))]) for (a, b), s in zip(fit.pairs, fit.pair_scores)]
    return classifier(spark, trees, cuts)
