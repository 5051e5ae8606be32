"""Untrained pipelines of the published models, on pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from roadlens.ml import features
from roadlens.ml.forest import ForestClassifier, ForestRegressor

SEED = 42
LABEL = "label"
# Trees that the original grows without a depth limit; Spark itself stops at 30.
DEEP = 30
# More node statistics per pass over the rows means fewer passes.
_FOREST = {"seed": SEED, "maxMemoryInMB": 1024}
# Rows of deep trees remember their node, so no level walks them from the root again.
_DEEP_FOREST = {**_FOREST, "cacheNodeIds": True, "checkpointInterval": -1}


def _encoded(texts: Sequence[str], drop_unseen: bool) -> list:
    """Index and one-hot encode; unseen values get a slot of their own, or all zeros."""
    indexed = [f"{name}_index" for name in texts]
    vectors = [f"{name}_encoded" for name in texts]
    return [
        StringIndexer(inputCols=list(texts), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(
            inputCols=indexed,
            outputCols=vectors,
            handleInvalid="error" if drop_unseen else "keep",
            dropLast=True,
        ),
    ]


def _assembled(inputs: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="keep")


def label_indexer(column: str) -> StringIndexer:
    """Classes in alphabetical order; an unknown class is an error, not a class of its own."""
    return StringIndexer(
        inputCol=column,
        outputCol=LABEL,
        stringOrderType="alphabetAsc",
        handleInvalid="error",
    )


def scaled_inputs(numbers: Sequence[str], texts: Sequence[str]) -> list:
    """Standardised numbers next to one-hot texts, where unseen texts are all zeros."""
    return [
        _assembled(numbers, "numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        *_encoded(texts, drop_unseen=True),
        _assembled(["scaled", *[f"{name}_encoded" for name in texts]]),
    ]


def plain_inputs(numbers: Sequence[str], texts: Sequence[str]) -> list:
    return [
        *_encoded(texts, drop_unseen=True),
        _assembled([*[f"{name}_encoded" for name in texts], *numbers]),
    ]


def volume_forecaster(trees: int = 150, depth: int = 12) -> Pipeline:
    """Volume from calendar, lags and the one-hot junction."""
    forest = ForestRegressor(
        labelCol="Vehicles", numTrees=trees, maxDepth=depth, minInstancesPerNode=2, **_FOREST
    )
    inputs = ["Junction_encoded", *features.VOLUME_INPUTS]
    return Pipeline(stages=[*_encoded(["Junction"], False), _assembled(inputs), forest])


def small_volume_forest(trees: int = 150, depth: int = DEEP, bootstrap: bool = True) -> Pipeline:
    """Volume from hour and junction alone."""
    forest = RandomForestRegressor(
        labelCol="Vehicles", numTrees=trees, maxDepth=depth, bootstrap=bootstrap, **_FOREST
    )
    if not bootstrap:
        forest.setFeatureSubsetStrategy("all")
    return Pipeline(stages=[_assembled(features.SMALL_VOLUME_INPUTS), forest])


def situation_inputs() -> Pipeline:
    inputs = [*features.SITUATION_INPUTS, "DayOfWeek_encoded"]
    return Pipeline(
        stages=[*_encoded(["DayOfWeek"], False), label_indexer("TrafficSituation"), _assembled(inputs)]
    )


def _situation(classifier: Estimator) -> Pipeline:
    return Pipeline(stages=[*situation_inputs().getStages(), classifier])


def situation_forest(trees: int = 120, depth: int = 10) -> Pipeline:
    return _situation(
        RandomForestClassifier(labelCol=LABEL, numTrees=trees, maxDepth=depth, **_FOREST)
    )


def _boosted(rounds: int, depth: int, n_classes: int, step: float = 0.1, weight=None) -> Estimator:
    """Spark's boosted trees know two classes; more are split one against the rest. For softmax over all
    classes see ``boosting``."""
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=SEED)
    if n_classes <= 2:
        trees.setLabelCol(LABEL)
        return trees.setWeightCol(weight) if weight else trees
    return OneVsRest(classifier=trees, labelCol=LABEL, weightCol=weight, parallelism=4)


def situation_boosted(n_classes: int, rounds: int = 80, depth: int = 6) -> Pipeline:
    return _situation(_boosted(rounds, depth, n_classes))


def small_situation_forest(trees: int = 200, depth: int = DEEP) -> Pipeline:
    forest = RandomForestClassifier(labelCol=LABEL, numTrees=trees, maxDepth=depth, **_FOREST)
    inputs = plain_inputs(features.SMALL_SITUATION_NUMBERS, features.SMALL_SITUATION_TEXTS)
    return Pipeline(stages=[label_indexer("traffic_situation"), *inputs, forest])


def small_risk_forest(trees: int = 200, depth: int = DEEP) -> Pipeline:
    forest = ForestClassifier(labelCol=LABEL, numTrees=trees, maxDepth=depth, **_DEEP_FOREST)
    inputs = plain_inputs(features.SMALL_RISK_NUMBERS, features.SMALL_RISK_TEXTS)
    return Pipeline(stages=[label_indexer("risk_level"), *inputs, forest])


def risk_inputs(numbers: Sequence[str] = features.RISK_NUMBERS) -> Pipeline:
    inputs = scaled_inputs(numbers, features.RISK_TEXTS)
    return Pipeline(stages=[label_indexer("risk_level"), *inputs])


def _risk(classifier: Estimator, numbers: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[*risk_inputs(numbers).getStages(), classifier])


def risk_logistic(numbers: Sequence[str] = features.RISK_NUMBERS, rounds: int = 2000) -> Pipeline:
    """Multinomial logistic regression on weighted rows."""
    model = LogisticRegression(
        labelCol=LABEL, weightCol="class_weight", maxIter=rounds, family="multinomial"
    )
    return _risk(model, numbers)


def risk_forest(
    numbers: Sequence[str] = features.RISK_NUMBERS, trees: int = 300, depth: int = DEEP
) -> Pipeline:
    """Weighted forest. A node needs two rows per side, the nearest Spark has to four to split."""
    model = ForestClassifier(
        labelCol=LABEL,
        weightCol="class_weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=2,
        **_DEEP_FOREST,
    )
    return _risk(model, numbers)


def risk_boosted(
    n_classes: int,
    numbers: Sequence[str] = features.RISK_NUMBERS,
    rounds: Sequence[int] = (100, 150),
    steps: Sequence[float] = (0.05, 0.1),
    depth: int = 3,
    folds: int = 3,
    parallelism: int = 2,
) -> CrossValidator:
    """Boosted trees over a grid of rounds and step sizes, by weighted F1 on the ``fold`` column."""
    booster = _boosted(rounds[0], depth, n_classes)
    trees = booster.getClassifier() if isinstance(booster, OneVsRest) else booster
    grid = (
        ParamGridBuilder().addGrid(trees.maxIter, list(rounds)).addGrid(trees.stepSize, list(steps))
    ).build()
    return CrossValidator(
        estimator=_risk(booster, numbers),
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
