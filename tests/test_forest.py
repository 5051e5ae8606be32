"""Forests grown by whole trees, against Spark's and against plain rules."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from roadlens.ml import forest
from roadlens.ml.forest import ForestClassifier, ForestModel, ForestRegressor

ROWS = 12_000


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(3)
    x = draw.integers(0, 20, (ROWS, 3)).astype(float)
    noise = draw.normal(size=ROWS)
    label = (x[:, 0] * 1.3 + x[:, 1] - 0.7 * x[:, 2] + 3 * noise > 14).astype(float) + (x[:, 1] > 15.0)
    value = x[:, 0] * x[:, 1] / 3 + 5 * noise
    weight = 1 + label / 4
    table = [(*map(float, x[i]), float(label[i]), float(value[i]), float(weight[i])) for i in range(ROWS)]
    frame = spark.createDataFrame(table, "a double, b double, c double, label double, value double, weight double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(frame).repartition(3).cache()


@pytest.fixture
def one_tree():
    """Without draws of rows or features a forest is one tree, whoever grows it."""
    return {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "seed": 5}


@pytest.mark.parametrize("more", [{"maxDepth": 4}, {"maxDepth": 9, "minInstancesPerNode": 3}, {"maxDepth": 7, "weightCol": "weight"}, {"maxDepth": 0}])
def test_one_tree_of_classes_is_sparks(rows, one_tree, more):
    ours = ForestClassifier(**one_tree, **more).fit(rows)
    assert isinstance(ours, ForestModel)
    spark_s = RandomForestClassifier(**one_tree, **more).fit(rows)
    key = ["a", "b", "c"]
    both = [
        {tuple(r[:3]): (r["prediction"], r["p"]) for r in m.transform(rows).select(*key, "prediction", vector_to_array("probability").alias("p")).distinct().collect()}
        for m in (ours, spark_s)
    ]
    assert both[0].keys() == both[1].keys()
    for cell, (prediction, p) in both[0].items():
        assert prediction == both[1][cell][0] and p == pytest.approx(both[1][cell][1], abs=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(spark_s.featureImportances.toArray(), abs=1e-6)


@pytest.mark.parametrize("more", [{"maxDepth": 5}, {"maxDepth": 12, "minInstancesPerNode": 2}])
def test_one_tree_of_values_is_sparks(rows, one_tree, more):
    ours, spark_s = (kind(labelCol="value", **one_tree, **more).fit(rows) for kind in (ForestRegressor, RandomForestRegressor))
    assert isinstance(ours, ForestModel)
    second = spark_s.transform(ours.transform(rows).withColumnRenamed("prediction", "ours").drop("_votes"))
    assert second.select(F.max(F.abs(F.col("ours") - F.col("prediction")))).first()[0] < 1e-9


def test_forest_is_as_good_as_sparks_and_does_not_depend_on_the_dealing(rows):
    train, test = rows.where("hash(a, b, c, value) % 5 != 0"), rows.where("hash(a, b, c, value) % 5 = 0")
    size = {"numTrees": 30, "maxDepth": 10, "seed": 5}
    hits = {}
    for kind in (ForestClassifier, RandomForestClassifier):
        model = kind(**size).fit(train.unionAll(test.limit(600)))
        hits[kind] = model.transform(test).select(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert hits[ForestClassifier] == pytest.approx(hits[RandomForestClassifier], abs=0.02)
    errors = {}
    for kind in (ForestRegressor, RandomForestRegressor):
        model = kind(labelCol="value", **size).fit(rows)
        errors[kind] = model.transform(rows).select(F.sqrt(F.avg((F.col("prediction") - F.col("value")) ** 2))).first()[0]
    assert errors[ForestRegressor] == pytest.approx(errors[RandomForestRegressor], rel=0.1)  # other draws
    first, again = (ForestClassifier(**size).fit(r)._known()[0] for r in (rows, rows.orderBy("value", "a").coalesce(1)))
    for a, b in zip(first, again, strict=True):
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.next, b.next) and np.array_equal(a.values, b.values)


def test_small_and_too_large_tables_are_sparks(rows, monkeypatch):
    assert not isinstance(ForestClassifier(numTrees=2).fit(rows.limit(9_000)), ForestModel)
    monkeypatch.setattr(forest, "_HELD", ROWS)
    assert not isinstance(ForestClassifier(numTrees=2).fit(rows), ForestModel)


def test_every_tree_draws_rows_and_features(rows):
    trees = ForestClassifier(numTrees=12, maxDepth=3).fit(rows)._known()[0]
    assert len({t.feature.tobytes() + t.bin.tobytes() for t in trees}) > 8
    assert {int(t.feature[0]) for t in trees} >= {0, 1}


def test_saved_model_answers_the_same(rows, tmp_path):
    model = PipelineModel([ForestClassifier(numTrees=5, maxDepth=4).fit(rows)])
    model.write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    asked = rows.limit(500).select("features")
    told = [m.transform(asked).select("prediction", "probability", "rawPrediction").collect() for m in (model, again)]
    assert told[0] == told[1]


def test_unknown_classes_and_numbers_are_errors(spark, rows):
    broken = rows.withColumn("a", F.when(F.col("a") == 3, float("nan")).otherwise(F.col("a")))
    broken = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(broken.drop("features"))
    with pytest.raises(Exception, match="numbers|NaN"):
        ForestRegressor(labelCol="value", numTrees=2).fit(broken)
