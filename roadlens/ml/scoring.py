"""Batch scoring: class with confidence, volume with confidence, all models side by side."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import rules
from roadlens.functions.bands import lookup
from roadlens.ml import features
from roadlens.ml.models import LABEL
from roadlens.operators.lineage import staged
from roadlens.operators.reshape import spread

_LEAF = re.compile(r"Predict: (\S+)")


def class_names(model: PipelineModel) -> list[str]:
    """Classes in the order of the model's label index."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.getOrDefault("outputCol") == LABEL:
            return list(stage.labels)
    raise ValueError("The pipeline has no label indexer.")


def _named(model: PipelineModel, index: Column) -> Column:
    return lookup(index, {float(i): name for i, name in enumerate(class_names(model))})


def _without_label(model: PipelineModel) -> PipelineModel:
    """Requests carry no label, so its indexer is left out."""
    kept = [
        stage
        for stage in model.stages
        if not (isinstance(stage, StringIndexerModel) and stage.getOrDefault("outputCol") == LABEL)
    ]
    return PipelineModel(kept)


def predict_classes(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``predicted`` (class name) and ``scores`` (one number per class)."""
    scored = _without_label(model).transform(rows)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.withColumns(
        {"predicted": _named(model, F.col("prediction")), "scores": vector_to_array(source)}
    )


def with_confidence(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds the predicted class and its probability.

    One-vs-rest models have a raw score per class: each becomes the probability its own model
    gives the class, and these are normalised over the classes.
    """
    scored = predict_classes(model, rows)
    chances = F.col("scores")
    if "probability" not in scored.columns:
        inner = model.stages[-1].models[0]
        # Boosted trees are fitted to labels -1 and 1, so their odds are of twice the margin.
        slope = 2.0 if isinstance(inner, GBTClassificationModel) else 1.0
        each = F.transform("scores", lambda raw: 1 / (1 + F.exp(-slope * raw)))
        total = F.aggregate(each, F.lit(0.0), lambda a, b: a + b)
        chances = F.transform(each, lambda chance: chance / total)
    return scored.withColumn("confidence_score", F.round(F.array_max(chances), 4))


def with_features_array(scored: DataFrame) -> DataFrame:
    return scored.withColumn("features_array", vector_to_array("features"))


def with_fare(predictions: DataFrame) -> DataFrame:
    """Adds the flat fare of the predicted volume."""
    return predictions.withColumn("predicted_fare", rules.flat_fare(F.col("prediction")))


def with_votes(forest, rows: DataFrame, votes: str = "votes") -> DataFrame:
    """Adds the forest's prediction and an array with the prediction of every tree.

    The forest tells the leaf of every tree in one walk; the leaves' values, as the trees list them from
    left to right, are one array behind all rows. So the plan does not grow with the number of trees.
    """
    leaves = [[float(value) for value in _LEAF.findall(tree.toDebugString)] for tree in forest.trees]
    starts = np.array([0, *accumulate(map(len, leaves))][:-1])
    values = np.array([value for own in leaves for value in own])

    @F.pandas_udf("array<double>")
    def of_leaves(places: pd.Series) -> pd.Series:
        if not len(places):
            return pd.Series([], dtype=object)
        return pd.Series(list(values[np.stack(places.to_numpy()).astype(np.int64) + starts]))

    scored = forest.copy({forest.leafCol: "_leaves"}).transform(rows)
    return scored.withColumn(votes, of_leaves(vector_to_array("_leaves"))).drop("_leaves")


def volume_with_confidence(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predicted volume, and 1 - spread of the trees / max(|prediction|, 1) kept in 0..1.

    Both follow from the model's inputs alone, so every different set of inputs is scored once and its
    answer joined to all rows that share it, null or not. ``rows`` are read twice.
    """
    inputs = [name for name in model.stages[0].getInputCols() if name in rows.columns]
    cells = staged(_volume_answers(model, rows.select(*inputs).distinct()))
    answers = [name for name in cells.columns if name not in inputs]
    named = cells.withColumnsRenamed({name: f"_cell_{name}" for name in inputs})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_cell_{name}")) for name in inputs])
    return rows.join(named, same, "left").select(*rows.columns, *answers)


def _volume_answers(model: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = with_votes(model.stages[-1], PipelineModel(model.stages[:-1]).transform(rows), "_votes")
    # The forest's own prediction is the mean of its trees.
    squares = F.transform("_votes", lambda vote: F.pow(vote - F.col("prediction"), 2))
    spread = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b) / F.size("_votes"))
    relative = spread / F.greatest(F.abs("prediction"), F.lit(1.0))
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - relative))
    return scored.withColumn("confidence_score", F.round(confidence, 4)).drop("_votes")


# Names of the three request models and of what they predict.
MODEL_NAMES = {
    "volume": ("Traffic Volume Regressor", "Predicted vehicle count"),
    "situation": ("Traffic Situation Classifier", "Predicted traffic situation"),
    "risk": ("Traffic Risk Classifier", "Predicted risk level"),
}


def compare_requests(
    requests: DataFrame,
    key: str,
    volume: PipelineModel,
    situation: PipelineModel,
    risk: PipelineModel,
) -> DataFrame:
    """Every valid request scored by all three models: one row per request and model."""
    requests = spread(staged(requests))
    scored = volume_with_confidence(volume, requests).select(
        *requests.columns,
        F.round("prediction", 2).cast("string").alias("_volume"),
        F.col("confidence_score").alias("_volume_confidence"),
    )
    for name, model in (("situation", situation), ("risk", risk)):
        before = scored.columns
        scored = with_confidence(model, scored).select(
            *before,
            F.col("predicted").alias(f"_{name}"),
            F.col("confidence_score").alias(f"_{name}_confidence"),
        )
    answers = [
        F.struct(
            F.lit(title).alias("model_name"),
            F.lit(what).alias("prediction_label"),
            F.col(f"_{name}").alias("prediction"),
            F.col(f"_{name}_confidence").alias("confidence_score"),
        )
        for name, (title, what) in MODEL_NAMES.items()
    ]
    return scored.select(key, F.explode(F.array(*answers)).alias("answer")).select(key, "answer.*")


def named_importances(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """Impurity importances of the last stage, named by the feature vector's own metadata."""
    groups = scored.schema["features"].metadata["ml_attr"]["attrs"].values()
    names = {item["idx"]: item["name"] for group in groups for item in group}
    values = model.stages[-1].featureImportances.toArray()
    rows = [(names.get(i, f"feature_{i}"), float(v)) for i, v in enumerate(values)]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double")


def request_columns() -> Sequence[str]:
    """All model inputs a request must bring."""
    numbers = [
        *features.SMALL_VOLUME_INPUTS,
        *features.SMALL_SITUATION_NUMBERS,
        *features.SMALL_RISK_NUMBERS,
    ]
    texts = [*features.SMALL_SITUATION_TEXTS, *features.SMALL_RISK_TEXTS]
    return list(dict.fromkeys([*numbers, *texts]))
