"""Softmax boosting against a few rounds by hand."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from roadlens.ml import boosting, models, training
from roadlens.ml.boosting import Member

CLASSES, ROUNDS, DEPTH = 3, 5, 2


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.integers(0, 6, 240), rng.normal(0, 1, 240).round(1), rng.integers(0, 2, 240)]).astype(float)
    y = (x[:, 0] > 2).astype(int) + (x[:, 1] > 0.3)
    y = np.where(rng.random(240) < 0.1, rng.integers(0, CLASSES, 240), y)
    return x, y, rng.integers(1, 4, 240).astype(float), np.arange(240) % 3


@pytest.fixture(scope="module")
def rows(spark, data):
    table = [(Vectors.dense(a), float(b), float(c), int(d)) for a, b, c, d in zip(*data)]
    return spark.createDataFrame(table, ["features", "label", "w", "fold"]).repartition(3).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    members = [Member(0.1), Member(0.5), Member(0.1, 0)]
    return boosting.fit(rows, CLASSES, members, ROUNDS, DEPTH, weight="w", fold="fold")


def by_hand(x, y, w, step):
    """Scores after every round: regression trees on residuals, leaves by a Newton step."""
    scores = np.repeat(np.log([[w[y == k].sum() / w.sum() for k in range(CLASSES)]]), len(x), axis=0)
    history = [scores]
    for _ in range(ROUNDS):
        p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
        new = scores.copy()
        for k in range(CLASSES):
            r = (y == k) - p[:, k]

            def grow(own, depth):
                def part(rows):
                    return (w[rows] * r[rows]).sum() ** 2 / w[rows].sum()

                best = (1e-12, None, None)
                for j in range(x.shape[1]) if depth < DEPTH else ():
                    for cut in np.unique(x[own, j])[:-1]:
                        left = own[x[own, j] <= cut]
                        gain = part(left) + part(np.setdiff1d(own, left)) - part(own)
                        if gain > best[0] + 1e-9:
                            best = (gain, j, cut)
                if best[1] is None:
                    size = (w[own] * np.abs(r[own]) * (1 - np.abs(r[own]))).sum()
                    new[own, k] += step * (CLASSES - 1) / CLASSES * (w[own] * r[own]).sum() / size
                    return
                left = own[x[own, best[1]] <= best[2]]
                grow(left, depth + 1)
                grow(np.setdiff1d(own, left), depth + 1)

            grow(np.arange(len(x)), 0)
        scores = new
        history.append(scores)
    return history


def scores_of(spark_model, rows):
    scored = spark_model.transform(rows).select("features", vector_to_array("rawPrediction").alias("raw")).collect()
    return {tuple(r["features"]): r["raw"] for r in scored}


@pytest.mark.parametrize("member, step, without", [(0, 0.1, None), (1, 0.5, None), (2, 0.1, 0)])
def test_rounds_equal_those_by_hand(rows, data, fitted, member, step, without):
    x, y, w, fold = data
    kept = fold != (-1 if without is None else without)
    history = by_hand(x[kept], y[kept], w[kept], step)
    for rounds in (1, ROUNDS):  # a shorter member is the beginning of the longer one
        got = scores_of(fitted.model(member, rounds), rows)
        for point, want in zip(x[kept], history[rounds]):
            assert got[tuple(point)] == pytest.approx(want, abs=1e-9)


def test_loss_falls_and_chances_sum_to_one(rows, fitted):
    losses = []
    for rounds in range(1, ROUNDS + 1):
        scored = fitted.model(1, rounds).transform(rows).withColumn("p", vector_to_array("probability"))
        total = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
        row = scored.agg(
            F.sum(-F.col("w") * F.log(F.get("p", F.col("label").cast("int")))).alias("loss"),
            F.max(F.abs(total - 1)).alias("off"),
            F.avg((F.get("p", F.col("prediction").cast("int")) == F.array_max("p")).cast("int")).alias("best"),
        ).first()
        assert row["off"] < 1e-12 and row["best"] == 1
        losses.append(row["loss"])
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.6 * losses[0]


def test_model_is_saved_and_read(rows, fitted, tmp_path):
    model = fitted.model(1, ROUNDS)
    PipelineModel([model]).write().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    assert scores_of(again, rows) == scores_of(model, rows)
    assert sum(model.featureImportances) == pytest.approx(1) and len(model.featureImportances) == 3


def test_held_out_rows_are_counted(rows, fitted, data):
    counted = boosting.held_out_counts(rows, fitted, [1, ROUNDS], "fold").collect()
    for rounds in (1, ROUNDS):
        own = [r for r in counted if r["rounds"] == rounds]
        assert {r["member"] for r in own} == {2} and sum(r["n"] for r in own) == 80
        scored = fitted.model(2, rounds).transform(rows.where("fold = 0"))
        hits = scored.where("prediction = label").count()
        assert sum(r["n"] for r in own if r["actual"] == r["predicted"]) == hits


def test_many_values_are_binned(spark):
    table = spark.range(3_000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("a"), (F.col("id") >= 1_500).cast("double").alias("label"))
    rows = table.select(array_to_vector("a").alias("features"), "label")
    few, one = boosting.feature_cuts(rows, 2, 16)
    assert len(few) == 15 and len(one) == 0 and np.abs(np.diff(few) - 3_000 / 16).max() < 40
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(rows.limit(0), 2, [Member(0.1)], 1, 1)


def test_grid_search_takes_the_best_cell(spark, data):
    x, y, _, fold = data
    table = spark.createDataFrame([(*map(float, a), "abc"[b], int(d)) for a, b, d in zip(x, y, fold)], "u double, v double, w double, name string, fold int")
    inputs = Pipeline(stages=[models.label_indexer("name"), VectorAssembler(inputCols=["u", "v", "w"], outputCol="features")])
    model, scores = training.search_softmax(inputs, table, CLASSES, (1, 3), (0.05, 0.6), 2, 3)
    cells = {(r["rounds"], r["step"]): r["f1_score"] for r in scores.collect()}
    assert set(cells) == {(1, 0), (1, 1), (3, 0), (3, 1)}
    rounds, step = max(sorted(cells), key=lambda c: cells[c])
    rows = inputs.fit(table).transform(table)
    # One cell again, fold by fold, from rows that really are left out.
    f1 = []
    for out in range(3):
        own = boosting.fit(rows.where(F.col("fold") != out), CLASSES, [Member((0.05, 0.6)[step])], rounds, 2)
        scored = own.model(0, rounds).transform(rows.where(F.col("fold") == out))
        f1.append(MulticlassClassificationEvaluator(labelCol="label", metricName="f1").evaluate(scored))
    assert cells[rounds, step] == pytest.approx(np.mean(f1))
    best = boosting.fit(rows, CLASSES, [Member((0.05, 0.6)[step])], rounds, 2).model(0, rounds)
    assert scores_of(model.stages[-1], rows) == scores_of(best, rows)
