"""Confidence numbers, class names and importances of fitted models."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.ml import features, models, scoring, training


@pytest.fixture(scope="module")
def volumes(spark):
    rng = random.Random(8)
    rows = [(h, j, float(10 * j + h + rng.randrange(8))) for h in range(24) for j in (1, 2, 3)] * 3
    return spark.createDataFrame(rows, "hour int, junction int, Vehicles double").cache()


def test_volume_confidence_is_spread_of_trees(volumes):
    model = models.small_volume_forest(trees=7, depth=4).fit(volumes)
    row = scoring.volume_with_confidence(model, volumes.limit(1)).first()
    votes = [tree.predict(row["features"]) for tree in model.stages[-1].trees]
    want = 1 - np.std(votes) / max(abs(np.mean(votes)), 1.0)
    assert row["prediction"] == pytest.approx(np.mean(votes))
    assert row["confidence_score"] == pytest.approx(round(min(1, max(0, want)), 4), abs=1e-4)
    assert not [c for c in row.asDict() if c.startswith("_")]


@pytest.fixture(scope="module")
def situations(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        cars = rng.randrange(100)
        name = "low" if cars < 30 else "normal" if cars < 60 else "high"
        rows.append((i, cars, 5, 2, 1, cars + 8, i % 24, f"day{i % 7}", name))
    return spark.createDataFrame(
        rows,
        "id int, car_count int, bike_count int, bus_count int, truck_count int,"
        " traffic_volume int, hour int, day_of_week string, traffic_situation string",
    ).cache()


def test_classes_confidence_and_unseen_text(spark, situations):
    model = models.small_situation_forest(trees=9, depth=5).fit(situations)
    assert scoring.class_names(model) == ["high", "low", "normal"]
    asked = situations.drop("traffic_situation").withColumn("day_of_week", F.lit("new day"))
    scored = scoring.with_confidence(model, asked)
    assert scored.count() == 300
    for row in scored.select("scores", "confidence_score", "predicted").collect():
        assert len(row["scores"]) == 3
        assert row["confidence_score"] == round(max(row["scores"]), 4)
        assert row["predicted"] == ["high", "low", "normal"][int(np.argmax(row["scores"]))]


def test_importances_are_named_and_sum_to_one(situations):
    model = models.small_situation_forest(trees=9, depth=5).fit(situations)
    scored = scoring.predict_classes(model, situations)
    table = scoring.named_importances(model, scored).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    best = max(table, key=lambda r: r["importance"])["feature"]
    assert best in ("car_count", "traffic_volume")
    assert sum(r["feature"].startswith("day_of_week") for r in table) == 7


def test_boosted_grid_over_more_than_two_classes(situations):
    rows = situations.select(
        "id",
        F.col("traffic_situation").alias("risk_level"),
        F.col("car_count").cast("double").alias("humidity"),
        *[F.lit("x").alias(name) for name in features.RISK_TEXTS],
    )
    folded = features.with_folds(rows, "id", "risk_level", 2)
    grid = models.risk_boosted(3, ["humidity"], rounds=(1, 2), steps=(0.1,), depth=2, folds=2)
    tried = [grid.getEstimator().copy(m).getStages()[-1] for m in grid.getEstimatorParamMaps()]
    assert [one.getClassifier().getMaxIter() for one in tried] == [1, 2]
    fitted = grid.fit(folded)
    best = fitted.bestModel.stages[-1].models[0]
    assert best.getNumTrees == [1, 2][int(np.argmax(fitted.avgMetrics))]
    assert len(fitted.avgMetrics) == 2
    scored = scoring.predict_classes(fitted.bestModel, rows)
    right = scored.where("predicted = risk_level").count()
    assert right / 300 > 0.9
    result = training.evaluate_classes("Gradient Boosting", fitted.bestModel, rows, "risk_level")
    assert result.metrics.first()["accuracy"] == pytest.approx(right / 300)


def test_most_frequent_breaks_ties_by_value(spark):
    table = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "t string")
    assert training.most_frequent(table, "t").first()["t"] == "a"


def test_all_model_inputs_are_request_fields():
    from roadlens.operators.requests import FIELDS

    assert set(scoring.request_columns()) <= set(FIELDS)


def test_votes_are_those_of_the_trees(volumes):
    forest = models.small_volume_forest(trees=12, depth=9).fit(volumes)
    inputs = forest.stages[0].transform(volumes).limit(40)
    rows = scoring.with_votes(forest.stages[-1], inputs).collect()
    for row in rows:
        assert row["votes"] == [tree.predict(row["features"]) for tree in forest.stages[-1].trees]
        assert row["prediction"] == pytest.approx(np.mean(row["votes"]))
    assert any(np.std(row["votes"]) > 0 for row in rows)


def test_the_plan_does_not_grow_with_the_trees(volumes):
    sizes = []
    for trees in (3, 30):
        model = models.small_volume_forest(trees=trees, depth=3).fit(volumes)
        plan = scoring.volume_with_confidence(model, volumes)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(plan.count("\n"))
    assert sizes[0] == sizes[1]
