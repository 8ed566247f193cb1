"""Tree ensembles of Spark ML, set up for residual regression."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.session import shared_dir

# The original settings where Spark has the knob: leaf-count and split-size caps
# do not exist here; the leaf-size minimum stands in for both.
FOREST = {"numTrees": 500, "maxDepth": 20, "minInstancesPerNode": 4, "featureSubsetStrategy": "all"}
DAILY_FOREST = {"numTrees": 10_000, "maxDepth": 20, "featureSubsetStrategy": "0.2"}
BOOSTED = {"maxIter": 500, "stepSize": 0.01, "maxDepth": 10, "subsamplingRate": 0.7}
STACK_BOOSTED = {"maxIter": 1000, "stepSize": 0.005, "maxDepth": 10, "subsamplingRate": 0.5}
STACK_FOREST = {"numTrees": 1000, "maxDepth": 20}


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Named columns, in the given order, to a vector; a missing value is an error."""
    df = df.drop(out)
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def forest(label: str, prediction: str = "prediction", seed: int = 7, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, predictionCol=prediction, seed=seed, **params)


def boosted(label: str, prediction: str = "prediction", seed: int = 7, **params) -> GBTRegressor:
    """Squared loss. Rounds are sequential: the running residuals are
    checkpointed in the shared directory every ten."""
    return GBTRegressor(
        labelCol=label, predictionCol=prediction, seed=seed, lossType="squared",
        checkpointInterval=10, **params,
    )


def tree(label: str, weight: str, seed: int = 7, **params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, weightCol=weight, seed=seed, **params)


SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def tree_nodes(model) -> tuple[np.ndarray, ...]:
    """Feature, threshold, left, right and value of every node of a fitted tree over
    numeric features, root first. A leaf has feature -1 and points at itself."""
    lines = iter(line.strip() for line in model.toDebugString.splitlines()[1:])
    nodes: list = []

    def read() -> int:
        at, line = len(nodes), next(lines)
        nodes.append(None)
        if line.startswith("Predict:"):
            nodes[at] = (-1, 0.0, at, at, float(line.removeprefix("Predict:")))
            return at
        split = SPLIT.fullmatch(line)
        if split is None:
            raise ValueError(f"not a split of a numeric feature: {line}")
        left = read()
        next(lines)  # the same split, negated
        nodes[at] = (int(split[1]), float(split[2]), left, read(), 0.0)
        return at

    read()
    return tuple(np.array(c) for c in zip(*nodes))


def score_trees(models: list, combine: Callable[[np.ndarray], np.ndarray], rows_at_once: int = 2000):
    """A column function of the feature array: ``combine`` of all trees' predictions
    (rows x trees) for each row. One projection however many trees there are."""
    members = [tree_nodes(m) for m in models]

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        parts = []
        for start in range(0, len(features), rows_at_once):
            x = np.stack(features.iloc[start : start + rows_at_once].to_list())
            rows, each = np.arange(len(x)), []
            for feature, threshold, left, right, value in members:
                at = np.zeros(len(x), int)
                while (feature[at] >= 0).any():
                    at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
                each.append(value[at])
            parts.append(combine(np.stack(each, axis=1)))
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return score


def importances(models: dict[str, object], features: list[str], spark) -> DataFrame:
    """``(segment, feature, importance)`` of fitted models: features x segments rows."""
    rows = [
        (segment, name, float(value))
        for segment, model in models.items()
        for name, value in zip(features, model.featureImportances.toArray())
    ]
    table = spark.createDataFrame(rows, "segment string, feature string, importance double")
    return table.withColumn("importance", F.round("importance", 9))


def ready(spark) -> None:
    """Boosting checkpoints need their directory before the first fit."""
    shared_dir(spark)
