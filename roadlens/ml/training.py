"""Training jobs: features, split, fit, evaluate, compare."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.config import DEFAULTS, Settings
from roadlens.ml import boosting, features, models, scoring
from roadlens.operators import evaluation
from roadlens.operators.lineage import staged
from roadlens.operators.reshape import medians, spread


@dataclass
class Fitted:
    """One trained model with its hold-out predictions and its quality."""

    name: str
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    extra: dict[str, DataFrame] = field(default_factory=dict)


def evaluate_classes(name: str, model: PipelineModel, test: DataFrame, label: str) -> Fitted:
    """Score the hold-out rows once; every quality table is a count over those scores."""
    scored = staged(scoring.predict_classes(model, spread(test)).withColumn("actual", F.col(label)))
    names = scoring.class_names(model)
    matrix = evaluation.confusion(scored, names)
    metrics = evaluation.classification_metrics(matrix).select(
        F.lit(name).alias("model"), "accuracy", *evaluation.REPORT
    )
    return Fitted(name, model, scored, metrics, {"confusion": matrix})


def train_volume(
    counts: DataFrame,
    ties: Sequence[str] | None = None,
    settings: Settings = DEFAULTS,
    trees: int = 150,
    depth: int = 12,
) -> Fitted:
    """Demand forecast: chronological split, forest, predicted volume and fare."""
    data = staged(features.demand_features(counts, ties))
    train, test = features.time_split(data)
    model = models.volume_forecaster(trees, depth).fit(spread(train))
    predictions = staged(scoring.with_fare(model.transform(spread(test))))
    name = "Volume forest"
    metrics = evaluation.regression_metrics(predictions).withColumn("model", F.lit(name))
    return Fitted(name, model, predictions, metrics)


def train_small_volume(counts: DataFrame, key: str, trees: int = 150) -> Fitted:
    train, test = features.random_split(features.small_volume_features(counts), key)
    model = models.small_volume_forest(trees).fit(spread(train))
    predictions = model.transform(test)
    metrics = evaluation.regression_metrics(predictions).select(
        F.round("mae", 2).alias("mae"), F.round("r2", 4).alias("r2")
    )
    return Fitted(scoring.MODEL_NAMES["volume"][0], model, predictions, metrics)


def train_situation(
    prepared: DataFrame,
    key: str,
    trees: int = 120,
    depth: int = 10,
    rounds: int = 80,
    boosted_depth: int = 6,
    softmax: bool = True,
) -> list[Fitted]:
    """Situation classifiers on the prepared vehicle mix: forest and boosted trees.

    More than two classes are boosted together (softmax), or one against the rest.
    """
    data = staged(prepared)
    n_classes = evaluation.distinct_labels(data, "TrafficSituation").first()["n_classes"]
    train, test = features.random_split(data, key)
    forest = models.situation_forest(trees, depth).fit(train)
    if softmax and n_classes > 2:
        boosted = fit_softmax(models.situation_inputs(), train, n_classes, rounds, boosted_depth)
    else:
        boosted = models.situation_boosted(n_classes, rounds, boosted_depth).fit(train)
    return [
        evaluate_classes("Random forest", forest, test, "TrafficSituation"),
        evaluate_classes("Boosted trees", boosted, test, "TrafficSituation"),
    ]


def fit_softmax(
    inputs: Pipeline, train: DataFrame, n_classes: int, rounds: int, depth: int, step: float = 0.1
) -> PipelineModel:
    """Inputs and a softmax booster of one size, as one model."""
    prepared = inputs.fit(train)
    fitted = boosting.fit(prepared.transform(train), n_classes, [boosting.Member(step)], rounds, depth)
    return PipelineModel([*prepared.stages, fitted.model(0, rounds)])


def search_softmax(
    inputs: Pipeline,
    folded: DataFrame,
    n_classes: int,
    rounds: Sequence[int],
    steps: Sequence[float],
    depth: int,
    folds: int,
) -> tuple[PipelineModel, DataFrame]:
    """The best softmax booster of a grid by weighted F1 on held-out folds, and the grid's scores.

    All cells of the grid grow in one fit: a step size with and without each fold is a member, and fewer
    rounds are the beginning of more. Among equals the cell with fewer rounds and the earlier step wins.
    """
    prepared = inputs.fit(folded)
    rows = prepared.transform(folded)
    members = [boosting.Member(step, out) for step in steps for out in (None, *range(folds))]
    fitted = boosting.fit(rows, n_classes, members, max(rounds), depth, fold="fold")
    counts = boosting.held_out_counts(rows, fitted, rounds, "fold")
    each = evaluation.classification_metrics(counts, ["member", "rounds"])
    place = F.floor(F.col("member") / (folds + 1)).cast("int").alias("step")
    scores = staged(each.groupBy("rounds", place).agg(F.avg("f1_score").alias("f1_score")))
    best = scores.orderBy(F.col("f1_score").desc(), "rounds", "step").first()
    winner = fitted.model(best["step"] * (folds + 1), best["rounds"])
    return PipelineModel([*prepared.stages, winner]), scores


def train_small_situation(mix: DataFrame, key: str, trees: int = 200) -> Fitted:
    data = staged(features.small_situation_features(mix))
    train, test = features.stratified_split(data, key, "traffic_situation")
    model = models.small_situation_forest(trees).fit(spread(train))
    return evaluate_classes(
        scoring.MODEL_NAMES["situation"][0], model, test, "traffic_situation"
    )


def train_small_risk(roads: DataFrame, key: str, trees: int = 200) -> Fitted:
    """Risk classifier on request-shaped rows; rows without a full set of inputs are left out."""
    data = staged(features.small_risk_features(roads).dropna(subset=features.SMALL_RISK_NUMBERS))
    train, test = features.stratified_split(data, key, "risk_level")
    model = models.small_risk_forest(trees).fit(spread(train))
    return evaluate_classes(scoring.MODEL_NAMES["risk"][0], model, test, "risk_level")


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row with the commonest value of the column, the smallest among equals."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), column).limit(1).select(column)


def impute_from_train(
    train: DataFrame,
    others: Sequence[DataFrame],
    numbers: Sequence[str],
    texts: Sequence[str],
) -> list[DataFrame]:
    """Fill gaps in all tables with the training rows' medians and commonest texts.

    One value per column is read once, so every table gets the same filling.
    """
    filling = medians(train, numbers).first().asDict()
    for name in texts:
        if (row := most_frequent(train, name).first()) is not None:
            filling[name] = row[name]
    doubles = {name: F.col(name).cast("double") for name in numbers}
    return [df.withColumns(doubles).fillna(filling) for df in (train, *others)]


def train_risk(
    roads: DataFrame,
    key: str,
    no_leak: bool = False,
    trees: int = 300,
    logistic_rounds: int = 2000,
    rounds: Sequence[int] = (100, 150),
    steps: Sequence[float] = (0.05, 0.1),
    folds: int = 3,
    boosted: bool = True,
    softmax: bool = True,
) -> list[Fitted]:
    """Three risk classifiers on one stratified split.

    ``no_leak`` leaves out the scores the label is derived from. More than two classes are boosted
    together (softmax), or one against the rest.
    """
    numbers = features.RISK_NUMBERS_NO_LEAK if no_leak else features.RISK_NUMBERS
    data = staged(features.risk_features(roads))
    train, test = features.stratified_split(data, key, "risk_level")
    train, test = impute_from_train(train, [test], numbers, features.RISK_TEXTS)
    weighted = staged(evaluation.with_class_weight(train, "risk_level"))

    fitted = [
        ("Logistic Regression", models.risk_logistic(numbers, logistic_rounds).fit(weighted)),
        ("Random Forest", models.risk_forest(numbers, trees).fit(spread(weighted))),
    ]
    if boosted:
        n_classes = evaluation.distinct_labels(weighted, "risk_level").first()["n_classes"]
        folded = staged(features.with_folds(weighted, key, "risk_level", folds))
        if softmax and n_classes > 2:
            best, _ = search_softmax(models.risk_inputs(numbers), folded, n_classes, rounds, steps, 3, folds)
        else:
            best = models.risk_boosted(n_classes, numbers, rounds, steps, folds=folds).fit(folded).bestModel
        fitted.append(("Gradient Boosting", best))
    return [evaluate_classes(name, model, test, "risk_level") for name, model in fitted]


def comparison(results: Sequence[Fitted], *measures: str) -> DataFrame:
    """One row per model, best first."""
    table = results[0].metrics
    for other in results[1:]:
        table = table.unionByName(other.metrics)
    return evaluation.leaderboard(table, *measures)


def best(results: Sequence[Fitted], *measures: str) -> Fitted:
    """The winning model; reads one row."""
    winner = comparison(results, *measures).first()["model"]
    return next(result for result in results if result.name == winner)


def risk_report(winner: Fitted, test_key: str, numbers, repeats: int = 5) -> dict[str, DataFrame]:
    """Class report, ROC points, weighted AUC and the top importances of the winner."""
    names = scoring.class_names(winner.model)
    points = evaluation.roc_points(winner.predictions, names)
    if hasattr(winner.model.stages[-1], "featureImportances"):
        importances = scoring.named_importances(winner.model, winner.predictions)
    else:
        importances = evaluation.permutation_importance(
            winner.predictions,
            test_key,
            [*numbers, *features.RISK_TEXTS],
            lambda rows: scoring.predict_classes(winner.model, rows),
            repeats=repeats,
        )
    return {
        "classification_report": evaluation.full_report(winner.extra["confusion"]),
        "roc_points": points,
        "roc_auc": evaluation.weighted_auc(points),
        "feature_importance_top20": evaluation.top_importances(importances),
    }
