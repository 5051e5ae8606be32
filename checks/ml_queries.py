"""Features, splits, metric operators (with SQL) and training and scoring jobs (rows only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.sensor_queries import rounded
from checks.summary_queries import _mix, risk_with
from checks.views import view, with_views
from roadlens.functions import rules, scalars
from roadlens.ml import features, models, scoring, training
from roadlens.operators import evaluation, junctions, requests, vehicles
from roadlens.operators.lineage import staged
from roadlens.operators.reshape import spread

_WAVES = ["hour_sin", "hour_cos", "rolling_mean_3"]


def _demand(spark, folder):
    return features.demand_features(view(spark, folder, "junction_counts"), ["ID"])


def demand_features(spark, folder):
    return rounded(_demand(spark, folder), 8, *_WAVES)


def time_split_sizes(spark, folder):
    train, test = features.time_split(_demand(spark, folder))
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.max("timestamp_seconds").alias("last_second")
    )


def _risk(spark, folder):
    return features.risk_features(view(spark, folder, "road_conditions"))


def risk_features(spark, folder):
    return _risk(spark, folder).select("event_id", *features.RISK_NUMBERS, *features.RISK_TEXTS,
                                       "risk_level")


def random_split_rows(spark, folder):
    train, test = features.random_split(view(spark, folder, "junction_counts"), "ID")
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.select("ID", "part")


def stratified_split_rows(spark, folder):
    rows = staged(_risk(spark, folder).select("event_id", "risk_level"))
    train, test = features.stratified_split(rows, "event_id", "risk_level")
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.select("event_id", "risk_level", "part")


def stratified_folds(spark, folder):
    rows = staged(_risk(spark, folder).select("event_id", "risk_level"))
    folded = features.with_folds(rows, "event_id", "risk_level")
    return folded.select("event_id", "risk_level", "fold")


def class_weights(spark, folder):
    return rounded(evaluation.class_weights(_risk(spark, folder), "risk_level"), 8, "weight")


def weighted_rows(spark, folder):
    rows = evaluation.with_class_weight(_risk(spark, folder), "risk_level")
    return rounded(rows.select("event_id", "class_weight"), 8, "class_weight")


def label_classes(spark, folder):
    table = evaluation.distinct_labels(_risk(spark, folder), "risk_level")
    return table.select("n_classes", F.concat_ws(",", "classes").alias("classes"))


def commonest_texts(spark, folder):
    conditions = view(spark, folder, "road_conditions")
    named = [
        training.most_frequent(conditions, name).select(
            F.lit(name).alias("column"), F.col(name).alias("value")
        )
        for name in ("weather_type", "weather_description")
    ]
    return named[0].unionByName(named[1])


# Metric operators over predictions that follow from the rows: the level of another scheme as
# predicted class, and the mean of the three rows before as predicted volume.


def _classified(spark, folder):
    both = rules.score_risk(
        _risk(spark, folder).select("event_id", "weather_description", "visibility_in_miles",
                                    "air_pollution_index", "traffic_volume",
                                    F.col("risk_level").alias("actual")),
        "labels",
    )
    total = F.col("total_risk_score")
    scores = F.array(*[
        1 / (1 + F.abs(total - middle)) for middle in (5, 0, 2, 8)
    ])
    return both.select("event_id", "actual", F.col("risk_level").alias("predicted"),
                       scores.alias("scores"))


_CLASSES = ["High", "Low", "Moderate", "Severe"]


def _matrix(spark, folder):
    return evaluation.confusion(_classified(spark, folder), _CLASSES)


def confusion(spark, folder):
    return _matrix(spark, folder)


def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_matrix(spark, folder), _CLASSES)


def classification_report(spark, folder):
    return rounded(evaluation.full_report(_matrix(spark, folder)), 8, *evaluation.REPORT)


def classification_metrics(spark, folder):
    table = evaluation.classification_metrics(_matrix(spark, folder))
    return rounded(table, 8, "accuracy", *evaluation.REPORT)


def roc_points(spark, folder):
    points = evaluation.roc_points(_classified(spark, folder), _CLASSES)
    return rounded(
        points.select("label", "threshold", "false_positive_rate", "true_positive_rate"),
        8, "threshold", "false_positive_rate", "true_positive_rate",
    )


def class_auc(spark, folder):
    points = evaluation.roc_points(_classified(spark, folder), _CLASSES)
    return rounded(evaluation.class_auc(points), 8, "auc")


def weighted_auc(spark, folder):
    points = evaluation.roc_points(_classified(spark, folder), _CLASSES)
    return rounded(evaluation.weighted_auc(points), 8, "roc_auc_ovr_weighted")


def _forecasted(spark, folder):
    return _demand(spark, folder).withColumnRenamed("rolling_mean_3", "prediction")


def regression_metrics(spark, folder):
    return rounded(evaluation.regression_metrics(_forecasted(spark, folder)), 8, "rmse", "mae", "r2")


def hourly_fit(spark, folder):
    table = junctions.hourly_fit(_forecasted(spark, folder))
    return rounded(table, 8, "average_actual", "average_predicted")


def residual_histogram(spark, folder):
    whole = _forecasted(spark, folder).withColumn("prediction", F.round("prediction"))
    table = evaluation.residual_histogram(whole)
    return rounded(table, 8, "bin_start", "bin_end")


def predicted_fares(spark, folder):
    return scoring.with_fare(_forecasted(spark, folder)).select("ID", "predicted_fare")


# Training and scoring, rows only. Model sizes are parameters; these are smaller than the defaults.


def volume_forecast(spark, folder):
    fitted = training.train_volume(view(spark, folder, "junction_counts"), ["ID"])
    return fitted.predictions.select("ID", "Junction", "Vehicles", "prediction", "predicted_fare")


def volume_forecast_quality(spark, folder):
    return training.train_volume(view(spark, folder, "junction_counts"), ["ID"]).metrics


def small_volume_quality(spark, folder):
    return training.train_small_volume(view(spark, folder, "junction_counts"), "ID").metrics


def volume_confidence(spark, folder):
    fitted = training.train_small_volume(view(spark, folder, "junction_counts"), "ID")
    rows = features.small_volume_features(view(spark, folder, "junction_counts"))
    return scoring.volume_with_confidence(fitted.model, rows).select(
        "ID", "prediction", "confidence_score"
    )


def small_volume_cells(spark, folder):
    """Without bootstrap every tree ends in the mean of its (hour, junction), and no tree differs."""
    rows = staged(features.small_volume_features(view(spark, folder, "junction_counts")))
    train, _ = features.random_split(rows, "ID")
    model = models.small_volume_forest(trees=3, bootstrap=False).fit(train)
    known = train.select("hour", "junction").distinct()
    scored = scoring.volume_with_confidence(model, rows.join(known, ["hour", "junction"]))
    return scored.select("ID", F.round("prediction", 8).alias("prediction"), "confidence_score")


def _prepared(spark, folder):
    return vehicles.prepare(_mix(spark, folder))


def _situations(spark, folder):
    return training.train_situation(
        _prepared(spark, folder), "slot", trees=20, depth=6, rounds=3, boosted_depth=3
    )


def situation_comparison(spark, folder):
    return training.comparison(_situations(spark, folder), "accuracy", "f1_score")


def situation_importances(spark, folder):
    forest = _situations(spark, folder)[0]
    return evaluation.top_importances(
        scoring.named_importances(forest.model, forest.predictions), 10
    )


def situation_predictions(spark, folder):
    chosen = training.best(_situations(spark, folder), "accuracy", "f1_score")
    return scoring.with_features_array(chosen.predictions).select(
        "Time", "Date", "DayOfWeek", "actual", "predicted",
        F.size("features_array").alias("n_features"),
    )


def small_situation_quality(spark, folder):
    return training.train_small_situation(_mix(spark, folder), "slot").metrics


def small_risk_quality(spark, folder):
    return training.train_small_risk(view(spark, folder, "road_conditions"), "event_id").metrics


def _risk_models(spark, folder):
    return training.train_risk(view(spark, folder, "road_conditions"), "event_id", no_leak=True)


def risk_comparison(spark, folder):
    return training.comparison(_risk_models(spark, folder), "f1_score", "accuracy")


def risk_permutation_importance(spark, folder):
    fitted = training.train_risk(
        view(spark, folder, "road_conditions"), "event_id", trees=5, logistic_rounds=20,
        boosted=False,
    )[0]
    report = training.risk_report(fitted, "event_id", features.RISK_NUMBERS, repeats=2)
    return report["feature_importance_top20"]


def request_comparison(spark, folder):
    conditions = view(spark, folder, "road_conditions")
    counts = view(spark, folder, "junction_counts")
    asked = conditions.join(
        counts.select(F.col("ID").alias("event_id"), "Junction"), "event_id"
    ).withColumns(
        {
            "hour": F.hour("date_time"),
            "junction": F.col("Junction"),
            "car_count": F.lit(35),
            "bike_count": F.lit(8),
            "bus_count": F.lit(3),
            "truck_count": F.lit(4),
            "day_of_week": F.date_format("date_time", "EEEE"),
        }
    )
    # Dealt and written down before they are checked: the checks take longest, and Spark would move them
    # before the dealing.
    checked = requests.validate(staged(spread(asked.select("event_id", *requests.FIELDS))))
    valid = checked.where(F.size("errors") == 0).drop("errors")
    return scoring.compare_requests(
        valid,
        "event_id",
        training.train_small_volume(counts, "ID").model,
        training.train_small_situation(_mix(spark, folder), "slot").model,
        training.train_small_risk(conditions, "event_id").model,
    )


QUERIES = {
    f.__name__: f
    for f in (
        demand_features,
        time_split_sizes,
        risk_features,
        random_split_rows,
        stratified_split_rows,
        stratified_folds,
        class_weights,
        weighted_rows,
        label_classes,
        commonest_texts,
        confusion,
        confusion_matrix,
        classification_report,
        classification_metrics,
        roc_points,
        class_auc,
        weighted_auc,
        regression_metrics,
        hourly_fit,
        residual_histogram,
        predicted_fares,
        volume_forecast,
        volume_forecast_quality,
        small_volume_quality,
        volume_confidence,
        small_volume_cells,
        situation_comparison,
        situation_importances,
        situation_predictions,
        small_situation_quality,
        small_risk_quality,
        risk_comparison,
        risk_permutation_importance,
        request_comparison,
    )
}

_DEMAND = """
SELECT * FROM (SELECT *, CAST(hour(DateTime) AS INT) AS hour,
  CAST(dayofweek(DateTime) + 1 AS INT) AS day_of_week, CAST(day(DateTime) AS INT) AS day_of_month,
  CAST(month(DateTime) AS INT) AS month,
  CASE WHEN dayofweek(DateTime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  sin(2 * pi() * hour(DateTime) / 24) AS hour_sin, cos(2 * pi() * hour(DateTime) / 24) AS hour_cos,
  CAST(floor(epoch(DateTime)) AS BIGINT) AS timestamp_seconds,
  lag(Vehicles, 1) OVER w AS lag_1, lag(Vehicles, 2) OVER w AS lag_2, lag(Vehicles, 24) OVER w AS lag_24,
  avg(Vehicles) OVER (PARTITION BY Junction ORDER BY DateTime, ID
    ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3
FROM junction_counts WINDOW w AS (PARTITION BY Junction ORDER BY DateTime, ID))
WHERE lag_24 IS NOT NULL
"""
_DEMAND_WITH = with_views("junction_counts", demand=_DEMAND)
_FILL = ", ".join(
    f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM scored)) AS {c}"
    for c in ("traffic_volume", "air_pollution_index", "humidity", "visibility_in_miles",
              "temperature", "rain_p_h", "snow_p_h", "hour")
)
_RISK_FEATURES = f"""
SELECT event_id, {_FILL}, weather_severity, visibility_risk, pollution_risk, traffic_risk,
  total_risk_score, coalesce(weather_type, 'Unknown') AS weather_type,
  coalesce(weather_description, 'Unknown') AS weather_description, weather_category,
  CASE WHEN hour BETWEEN 8 AND 10 OR hour BETWEEN 17 AND 20 THEN 'Yes' ELSE 'No' END AS rush_hour,
  risk_level
FROM scored"""
_HASH = "('0x' || substr(md5('42:' || {}), 1, 13))::BIGINT"


def _risk_sql(**steps: str) -> str:
    return risk_with("training", features=_RISK_FEATURES, **steps)


def _classified_sql(**steps: str) -> str:
    """Rows with the training level as actual and the labels level as predicted class."""
    from checks.summary_queries import RISK_SQL

    labels = RISK_SQL["labels"].replace("road_conditions", "refilled")
    return _risk_sql(
        refilled="""
SELECT event_id, make_timestamp(2024, 1, 1, CAST(hour AS BIGINT), 0, 0.0) AS date_time,
  weather_description, visibility_in_miles, air_pollution_index, traffic_volume,
  risk_level AS actual FROM features""",
        labeled=labels,
        classified="""
SELECT event_id, actual, risk_level AS predicted, [1 / (1 + abs(total_risk_score - 5)),
  1 / (1 + abs(total_risk_score - 0)), 1 / (1 + abs(total_risk_score - 2)),
  1 / (1 + abs(total_risk_score - 8))] AS scores FROM labeled""",
        classes="SELECT unnest(['High', 'Low', 'Moderate', 'Severe']) AS label",
        matrix="""
SELECT a.label AS actual, p.label AS predicted,
  (SELECT count(*) FROM classified c WHERE c.actual = a.label AND c.predicted = p.label) AS n
FROM classes a, classes p""",
        report="""
SELECT *, coalesce(hits / nullif(claimed, 0), 0.0) AS precision,
  coalesce(hits / nullif(support, 0), 0.0) AS recall,
  coalesce(2 * hits / nullif(claimed + support, 0), 0.0) AS f1_score
FROM (SELECT label,
    CAST((SELECT sum(n) FROM matrix WHERE actual = label) AS DOUBLE) AS support,
    CAST((SELECT sum(n) FROM matrix WHERE predicted = label) AS DOUBLE) AS claimed,
    CAST((SELECT sum(n) FROM matrix WHERE actual = label AND predicted = label) AS DOUBLE) AS hits
  FROM classes)""",
        one_score="""
SELECT label, scores[list_position(['High', 'Low', 'Moderate', 'Severe'], label)] AS score,
  CASE WHEN actual = label THEN 1 ELSE 0 END AS hit FROM classified, classes""",
        curve="""
SELECT label, score, sum(hit) AS pos, sum(1 - hit) AS neg,
  sum(sum(hit)) OVER w AS tp, sum(sum(1 - hit)) OVER w AS fp,
  sum(sum(hit)) OVER (PARTITION BY label) AS p, sum(sum(1 - hit)) OVER (PARTITION BY label) AS n
FROM one_score GROUP BY label, score WINDOW w AS (PARTITION BY label ORDER BY score DESC)""",
        areas="""
SELECT label, round(sum(neg * (tp - pos / 2)) / (first(p) * first(n)), 8) AS auc,
  CAST(first(p) AS BIGINT) AS support FROM curve WHERE p > 0 AND n > 0 GROUP BY label""",
        **steps,
    )


_ROUNDED = ", ".join(f"round({c}, 8) AS {c}" for c in ("precision", "recall", "f1_score"))
_WEIGHTED = ", ".join(
    f"round(sum({c} * support) / sum(support), 8) AS {c}"
    for c in ("precision", "recall", "f1_score")
)

ORACLES = {
    "demand_features": _DEMAND_WITH + """
SELECT * REPLACE (round(hour_sin, 8) AS hour_sin, round(hour_cos, 8) AS hour_cos,
  round(rolling_mean_3, 8) AS rolling_mean_3) FROM demand""",
    "time_split_sizes": _DEMAND_WITH + """
SELECT CASE WHEN timestamp_seconds <= (SELECT quantile_disc(timestamp_seconds, 0.8) FROM demand)
  THEN 'train' ELSE 'test' END AS part, count(*) AS n, max(timestamp_seconds) AS last_second
FROM demand GROUP BY 1""",
    "risk_features": _risk_sql() + "SELECT * FROM features",
    "random_split_rows": with_views("junction_counts") + f"""
SELECT ID, CASE WHEN {_HASH.format("ID")} / 4503599627370496.0::DOUBLE < 0.8
  THEN 'train' ELSE 'test' END AS part FROM junction_counts""",
    "small_volume_cells": with_views("junction_counts") + f"""
SELECT ID, round(prediction, 8) AS prediction, 1.0::DOUBLE AS confidence_score
FROM (SELECT *, hour(DateTime) AS h FROM junction_counts)
JOIN (SELECT hour(DateTime) AS h, Junction, avg(Vehicles) AS prediction FROM junction_counts
  WHERE {_HASH.format("ID")} / 4503599627370496.0::DOUBLE < 0.8 GROUP BY 1, 2) USING (h, Junction)""",
    "stratified_split_rows": _risk_sql(hashed=f"""
SELECT event_id, risk_level, {_HASH.format("event_id")} AS h FROM features""") + """
SELECT event_id, risk_level, CASE WHEN h <= cut THEN 'train' ELSE 'test' END AS part
FROM hashed JOIN (SELECT risk_level, quantile_disc(h, 0.8) AS cut FROM hashed GROUP BY risk_level)
  USING (risk_level)""",
    "stratified_folds": _risk_sql(hashed=f"""
SELECT event_id, risk_level, {_HASH.format("event_id")} AS h FROM features""") + """
SELECT event_id, risk_level, CASE WHEN h <= a THEN 0 WHEN h <= b THEN 1 ELSE 2 END AS fold
FROM hashed JOIN (SELECT risk_level, quantile_disc(h, 1 / 3::DOUBLE) AS a,
    quantile_disc(h, 2 / 3::DOUBLE) AS b FROM hashed GROUP BY risk_level) USING (risk_level)""",
    "class_weights": _risk_sql() + """
SELECT risk_level, count(*) AS n, round((SELECT count(*) / count(DISTINCT risk_level) FROM features)
  / count(*), 8) AS weight FROM features GROUP BY risk_level""",
    "weighted_rows": _risk_sql(weights="""
SELECT risk_level, round((SELECT count(*) / count(DISTINCT risk_level) FROM features)
  / count(*), 8) AS class_weight FROM features GROUP BY risk_level""") + """
SELECT event_id, class_weight FROM features JOIN weights USING (risk_level)""",
    "label_classes": _risk_sql() + """
SELECT CAST(count(DISTINCT risk_level) AS INT) AS n_classes,
  string_agg(DISTINCT risk_level, ',' ORDER BY risk_level) AS classes FROM features""",
    "commonest_texts": with_views("road_conditions") + """
SELECT * FROM (SELECT 'weather_type' AS "column", weather_type AS value FROM road_conditions
  WHERE weather_type IS NOT NULL GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'weather_description' AS "column", weather_description AS value
  FROM road_conditions WHERE weather_description IS NOT NULL
  GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)""",
    "confusion": _classified_sql() + "SELECT * FROM matrix",
    "confusion_matrix": _classified_sql() + """
SELECT actual, CAST(sum(CASE WHEN predicted = 'High' THEN n END) AS BIGINT) AS "High",
  CAST(sum(CASE WHEN predicted = 'Low' THEN n END) AS BIGINT) AS "Low",
  CAST(sum(CASE WHEN predicted = 'Moderate' THEN n END) AS BIGINT) AS "Moderate",
  CAST(sum(CASE WHEN predicted = 'Severe' THEN n END) AS BIGINT) AS "Severe"
FROM matrix GROUP BY actual""",
    "classification_report": _classified_sql() + f"""
SELECT label, {_ROUNDED}, CAST(support AS BIGINT) AS support FROM report
UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8),
  round(avg(f1_score), 8), CAST(sum(support) AS BIGINT) FROM report
UNION ALL SELECT 'weighted avg', {_WEIGHTED}, CAST(sum(support) AS BIGINT) FROM report""",
    "classification_metrics": _classified_sql() + f"""
SELECT round(sum(hits) / sum(support), 8) AS accuracy, {_WEIGHTED} FROM report""",
    "roc_points": _classified_sql() + """
SELECT label, round(score, 8) AS threshold, round(fp / n, 8) AS false_positive_rate,
  round(tp / p, 8) AS true_positive_rate FROM curve WHERE p > 0 AND n > 0
UNION ALL SELECT DISTINCT label, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM curve WHERE p > 0 AND n > 0""",
    "class_auc": _classified_sql() + "SELECT * FROM areas",
    "weighted_auc": _classified_sql() + """
SELECT round(sum(neg_share * p) / (SELECT sum(support) FROM areas), 8) AS roc_auc_ovr_weighted
FROM (SELECT sum(neg * (tp - pos / 2)) / (first(p) * first(n)) AS neg_share, first(p) AS p
  FROM curve WHERE p > 0 AND n > 0 GROUP BY label)""",
    "regression_metrics": _DEMAND_WITH + """
SELECT round(sqrt(avg(e * e)), 8) AS rmse, round(avg(abs(e)), 8) AS mae,
  round(1 - avg(e * e) / var_pop(Vehicles), 8) AS r2
FROM (SELECT Vehicles, Vehicles - rolling_mean_3 AS e FROM demand)""",
    "hourly_fit": _DEMAND_WITH + """
SELECT CAST(hour AS INT) AS hour_of_day, round(avg(Vehicles), 8) AS average_actual,
  round(avg(rolling_mean_3), 8) AS average_predicted FROM demand GROUP BY 1""",
    "residual_histogram": with_views(
        "junction_counts", demand=_DEMAND,
        residuals="SELECT Vehicles - round(rolling_mean_3) AS r FROM demand",
        ends="SELECT min(r) AS low, max(r) AS high FROM residuals",
        counted="""
SELECT least(CAST(floor((r - low) / ((high - low) / 30)) AS INT), 29) AS bin, count(*) AS n
FROM residuals, ends GROUP BY 1""",
    ) + """
SELECT CAST(b AS INT) AS bin, round(low + b * ((high - low) / 30), 8) AS bin_start,
  round(low + (b + 1) * ((high - low) / 30), 8) AS bin_end, coalesce(n, 0) AS n
FROM range(30) t(b) LEFT JOIN counted ON bin = b, ends""",
    "predicted_fares": _DEMAND_WITH + """
SELECT ID, CASE WHEN rolling_mean_3 > 50 THEN 60 WHEN rolling_mean_3 > 20 THEN 30 ELSE 10 END
  AS predicted_fare FROM demand""",
}
