"""Trained forests and logistic models as columns: scoring in generated code, without vectors and without the models' own transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions.numbers import sigmoid


def _leaf_number(node, features: Sequence[str], leaves: list[list[float]]) -> str:
    """SQL for the number of the leaf that a row reaches from a node; the class shares of each leaf go to ``leaves``."""
    if node.getClass().getSimpleName() == "LeafNode":
        counts = list(node.impurityStats().stats())
        total = sum(counts)
        leaves.append([float(n / total if total else 0.0) for n in counts])
        return str(len(leaves) - 1)
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError("only splits by a threshold can be written as a column")
    below = f"CAST(`{features[split.featureIndex()]}` AS DOUBLE) <= DOUBLE('{float(split.threshold())!r}')"
    left = _leaf_number(node.leftChild(), features, leaves)
    return f"CASE WHEN {below} THEN {left} ELSE {_leaf_number(node.rightChild(), features, leaves)} END"


def with_forest_prediction(df: DataFrame, model: RandomForestClassificationModel, features: Sequence[str], name: str) -> DataFrame:
    """Add the label index with the most votes of all trees, the lowest of equal ones; ``features`` in the order of the model's vector.

    A tree gives the number of a leaf, and the shares of its leaves are a constant list for each class, so a row needs no
    array or function call of its own. The leaf numbers are a projection of their own, each used by all classes: for results that are
    selected or aggregated, as a filter on one would be pushed down with every tree written out once for each use.
    """
    numbers, votes = [], [None] * model.numClasses
    for t, tree in enumerate(model.trees):
        leaves: list[list[float]] = []
        numbers.append(F.expr(_leaf_number(tree._call_java("rootNode"), features, leaves)).alias(f"_leaf_{t}"))
        for c in range(model.numClasses):
            share = F.get(F.lit([shares[c] for shares in leaves]), F.col(f"_leaf_{t}"))
            votes[c] = share if votes[c] is None else votes[c] + share
    reached = df.select("*", *numbers)
    counted = reached.select(*df.columns, F.array(*votes).alias("_votes"))
    best = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
    return counted.select(*df.columns, best.alias(name))


def logistic_chance(model: PipelineModel, features: Sequence[str]) -> Column:
    """The chance of label 1 by a saved pipeline of scaler and logistic model; ``features`` in the order of its vector, null as 0."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    fitted = model.stages[-1]
    total = F.lit(float(fitted.intercept))
    for name, weight, spread in zip(features, fitted.coefficients, scaler.std, strict=True):
        # A feature without spread is scaled to 0.
        if spread:
            total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(weight / spread))
    return sigmoid(total)
