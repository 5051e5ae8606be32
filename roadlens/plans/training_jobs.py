"""Training jobs that write their model, metrics, comparison and sample predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.config import DEFAULTS, Settings
from roadlens.ml import features, scoring, training
from roadlens.ml.training import Fitted
from roadlens.operators import evaluation, junctions, vehicles
from roadlens.sources import sinks

SAMPLE_ROWS = 15


def sample_predictions(predictions: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """The first test rows by key, with actual and predicted class."""
    named = [
        F.col("actual").alias("actual_label"),
        F.col("predicted").alias("predicted_label"),
    ]
    return predictions.orderBy(key).limit(SAMPLE_ROWS).select(*columns, *named)


def metrics_document(
    results: Sequence[Fitted], winner: Fitted, report: dict[str, DataFrame]
) -> DataFrame:
    """One row: the winner, and an array ``models`` with the name of each model, its metrics,
    class report and confusion matrix."""
    spark = winner.metrics.sparkSession
    parts = {}
    for number, result in enumerate(results):
        matrix = result.extra["confusion"]
        parts[f"metrics_{number}"] = result.metrics
        parts[f"classification_report_{number}"] = evaluation.full_report(matrix)
        parts[f"confusion_matrix_{number}"] = matrix
    own = ("metrics", "classification_report", "confusion_matrix")
    models = F.array(
        *[
            F.struct(F.lit(result.name).alias("model_name"), *[F.col(f"{part}_{i}").alias(part) for part in own])
            for i, result in enumerate(results)
        ]
    )
    extra = {name: report[name] for name in ("roc_auc", "feature_importance_top20") if name in report}
    row = sinks.document(spark, {"best_model": winner.name}, {**parts, **extra})
    return row.withColumn("models", models).drop(*parts)


def demand(
    counts: DataFrame,
    output: str,
    ties: Sequence[str] | None = None,
    settings: Settings = DEFAULTS,
    **size: int,
) -> Fitted:
    """Demand forecast: predictions with fares, metrics, hourly fit, residual histogram."""
    fitted = training.train_volume(counts, ties, settings, **size)
    sinks.write_table(
        fitted.predictions.select(
            "DateTime", "Junction", "Vehicles", "prediction", "predicted_fare"
        ),
        f"{output}/predictions",
    )
    spark = fitted.predictions.sparkSession
    predictions = spark.read.parquet(f"{output}/predictions")
    sinks.write_document(fitted.metrics, f"{output}/metrics")
    sinks.write_table(junctions.hourly_fit(predictions), f"{output}/hourly_fit")
    sinks.write_table(evaluation.residual_histogram(predictions), f"{output}/residuals")
    sinks.save_model(fitted.model, f"{output}/forecaster", {"model_name": fitted.name})
    return fitted


def situation(raw: DataFrame, key: str, output: str, **size: int) -> Fitted:
    """Vehicle-mix classifiers: comparison, importances, the better one saved."""
    results = training.train_situation(vehicles.prepare(raw), key, **size)
    table = training.comparison(results, "accuracy", "f1_score")
    sinks.write_csv(table, f"{output}/model_comparison.csv")
    forest = results[0]
    importances = scoring.named_importances(forest.model, forest.predictions)
    sinks.write_table(evaluation.top_importances(importances, 10), f"{output}/importances")
    winner = training.best(results, "accuracy", "f1_score")
    report = {"feature_importance_top20": evaluation.top_importances(importances)}
    sinks.write_document(metrics_document(results, winner, report), f"{output}/metrics_summary.json")
    sinks.save_model(winner.model, f"{output}/best_model", {"model_name": winner.name})
    return winner


def risk(
    conditions: DataFrame, key: str, output: str, no_leak: bool = False, repeats: int = 5, **size
) -> Fitted:
    """Three risk classifiers: comparison, full metrics, sample predictions, best one saved."""
    numbers = features.RISK_NUMBERS_NO_LEAK if no_leak else features.RISK_NUMBERS
    results = training.train_risk(conditions, key, no_leak=no_leak, **size)
    winner = training.best(results, "f1_score", "accuracy")
    report = training.risk_report(winner, key, numbers, repeats)
    sinks.write_csv(
        training.comparison(results, "f1_score", "accuracy"), f"{output}/model_comparison.csv"
    )
    columns = [*numbers, *features.RISK_TEXTS]
    sinks.write_csv(
        sample_predictions(winner.predictions, columns, key), f"{output}/sample_predictions.csv"
    )
    sinks.write_table(report["roc_points"], f"{output}/roc_points")
    sinks.write_document(metrics_document(results, winner, report), f"{output}/metrics_summary.json")
    facts = {
        "model_name": winner.name,
        "target_labels": scoring.class_names(winner.model),
        "numeric_columns": list(numbers),
        "categorical_columns": list(features.RISK_TEXTS),
    }
    sinks.save_model(winner.model, f"{output}/best_model", facts)
    return winner


def request_models(
    spark: SparkSession, folder: str, counts: DataFrame, mix: DataFrame, conditions: DataFrame,
    keys: tuple[str, str, str], trees: dict[str, int] | None = None,
) -> dict[str, PipelineModel]:
    """The three request models, each trained only if it is not saved under ``folder``."""
    size = {"volume": 150, "situation": 200, "risk": 200, **(trees or {})}

    def saved(kind: str, train, inputs: Sequence[str], target: str) -> PipelineModel:
        def fit():
            fitted = train()
            facts = {
                "model_name": fitted.name,
                "model_type": "regression" if kind == "volume" else "classification",
                "feature_names": list(inputs),
                "target_name": target,
                "classes": [] if kind == "volume" else scoring.class_names(fitted.model),
                "metrics": {
                    k: float(v)
                    for k, v in fitted.metrics.first().asDict().items()
                    if k in ("mae", "r2", "accuracy", "f1_score")
                },
            }
            return fitted.model, {k: v for k, v in facts.items() if v != []}

        return sinks.model_or_train(spark, f"{folder}/{kind}", fit)

    situation_inputs = [*features.SMALL_SITUATION_NUMBERS, *features.SMALL_SITUATION_TEXTS]
    risk_inputs = [*features.SMALL_RISK_NUMBERS, *features.SMALL_RISK_TEXTS]
    return {
        "volume": saved(
            "volume",
            lambda: training.train_small_volume(counts, keys[0], size["volume"]),
            features.SMALL_VOLUME_INPUTS,
            "Vehicles",
        ),
        "situation": saved(
            "situation",
            lambda: training.train_small_situation(mix, keys[1], size["situation"]),
            situation_inputs,
            "traffic_situation",
        ),
        "risk": saved(
            "risk",
            lambda: training.train_small_risk(conditions, keys[2], size["risk"]),
            risk_inputs,
            "risk_level",
        ),
    }
