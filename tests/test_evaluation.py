"""Metric operators against direct formulas in Python."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from roadlens.ml import features
from roadlens.operators import evaluation

LABELS = ["High", "Low", "Severe"]


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        actual = rng.choice(["High", "Low", "Low", "Low"])
        scores = [round(rng.random() + (actual == name) * 0.4, 1) for name in LABELS]
        rows.append((i, actual, LABELS[scores.index(max(scores))], scores))
    return spark.createDataFrame(
        rows, "id int, actual string, predicted string, scores array<double>"
    ).cache()


def test_confusion_is_whole(predictions):
    table = evaluation.confusion(predictions, LABELS).collect()
    assert len(table) == 9
    assert sum(r["n"] for r in table) == 400
    assert all(r["n"] == 0 for r in table if r["actual"] == "Severe")


def test_report_and_metrics(predictions):
    rows = predictions.collect()
    matrix = evaluation.confusion(predictions, LABELS)
    report = {r["label"]: r for r in evaluation.full_report(matrix).collect()}
    want = {}
    for name in LABELS:
        hits = sum(r["actual"] == r["predicted"] == name for r in rows)
        claimed = sum(r["predicted"] == name for r in rows)
        support = sum(r["actual"] == name for r in rows)
        p = hits / claimed if claimed else 0.0
        q = hits / support if support else 0.0
        want[name] = (p, q, 2 * p * q / (p + q) if p + q else 0.0, support)
        got = report[name]
        assert (got["precision"], got["recall"], got["f1_score"], got["support"]) == pytest.approx(
            want[name]
        )
    assert report["macro avg"]["f1_score"] == pytest.approx(np.mean([w[2] for w in want.values()]))
    total = sum(w[2] * w[3] for w in want.values()) / 400
    metrics = evaluation.classification_metrics(matrix).first()
    assert metrics["f1_score"] == pytest.approx(total)
    assert metrics["accuracy"] == pytest.approx(
        sum(r["actual"] == r["predicted"] for r in rows) / 400
    )


def test_auc_equals_spark_and_skips_absent_class(predictions):
    points = evaluation.roc_points(predictions, LABELS).cache()
    aucs = {r["label"]: r["auc"] for r in evaluation.class_auc(points).collect()}
    assert set(aucs) == {"High", "Low"}
    for place, name in enumerate(LABELS[:2]):
        binary = predictions.select(
            (F.col("actual") == name).cast("double").alias("label"),
            F.col("scores")[place].alias("rawPrediction"),
        )
        want = BinaryClassificationEvaluator(numBins=0).evaluate(binary)
        assert aucs[name] == pytest.approx(want)
    last = points.groupBy("label").agg(
        F.max("false_positive_rate").alias("f"), F.max("true_positive_rate").alias("t")
    )
    assert {(r["f"], r["t"]) for r in last.collect()} == {(1.0, 1.0)}


def test_histogram_matches_numpy(spark):
    rng = random.Random(1)
    pairs = [(float(rng.randrange(100)), float(rng.randrange(50))) for _ in range(500)]
    table = spark.createDataFrame(pairs, "Vehicles double, prediction double")
    counts, edges = np.histogram([a - b for a, b in pairs], bins=30)
    got = evaluation.residual_histogram(table).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(counts)
    assert [r["bin_start"] for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_one_value(spark):
    table = spark.createDataFrame([(1.0, 1.0)] * 4, "Vehicles double, prediction double")
    got = evaluation.residual_histogram(table).orderBy("bin").collect()
    assert sum(r["n"] for r in got) == 4


def test_permutation_importance_finds_the_used_feature(spark):
    rows = [(i, "yes" if i % 2 else "no", float(i % 2), float(i)) for i in range(200)]
    table = spark.createDataFrame(rows, "id int, actual string, used double, idle double")

    def predict(df):
        return df.withColumn("predicted", F.when(F.col("used") > 0.5, "yes").otherwise("no"))

    got = {r["feature"]: r["importance"] for r in evaluation.permutation_importance(
        table, "id", ["used", "idle"], predict, repeats=2).collect()}
    assert got["idle"] == 0.0
    assert 0.3 < got["used"] < 0.7


def test_splits_cover_all_rows_once(spark):
    table = spark.range(1000).withColumn("label", F.when(F.col("id") % 10 == 0, "a").otherwise("b"))
    for train, test in (
        features.random_split(table, "id"),
        features.stratified_split(table, "id", "label"),
    ):
        assert train.count() + test.count() == 1000
        assert train.join(test, "id").count() == 0
    assert train.where("label = 'a'").count() == 80
    assert train.where("label = 'b'").count() == 720
    folded = features.with_folds(table, "id", "label")
    sizes = folded.where("label = 'a'").groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in sizes] == [34, 33, 33]
    assert set(r["fold"] for r in sizes) == {0, 1, 2}


def test_class_weights_balance(spark):
    table = spark.range(100).withColumn("label", F.when(F.col("id") < 10, "a").otherwise("b"))
    total = evaluation.with_class_weight(table, "label").groupBy("label").agg(
        F.sum("class_weight").alias("w")
    )
    assert [round(r["w"], 6) for r in total.collect()] == [50.0, 50.0]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 1_000, 1_024, 1_025])
def test_permuted_places_are_a_permutation(spark, n):
    table = spark.range(n).select("id", *[
        evaluation.permuted(F.col("id"), n, 42, F.lit(key)).alias(f"p{key}") for key in (1, 2)
    ])
    rows = table.collect()
    for key in (1, 2):
        assert sorted(r[f"p{key}"] for r in rows) == list(range(n))
    if n >= 100:
        assert sum(r["p1"] == r["id"] for r in rows) < 8 and sum(r["p1"] == r["p2"] for r in rows) < 8


def test_permutation_importance_against_dealt_rows(spark):
    """The loss of a rule, from the very rows the permutations deal."""
    rows = [(i, "abc"[i % 3], float(i % 3), i % 5) for i in range(97)]
    table = spark.createDataFrame(rows, "id int, actual string, used double, idle int")

    def predict(df):
        return df.withColumn("predicted", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("used").cast("int") + 1))

    got = evaluation.permutation_importance(table, "id", ["used", "idle"], predict, repeats=5, seed=3).collect()
    places = spark.range(97).select("id", *[evaluation.permuted(F.col("id"), 97, 3, F.lit(r)).alias(f"p{r}") for r in range(1, 6)]).collect()
    numbered = evaluation.row_positions(table.withColumn("_h", evaluation.uniform_hash(F.col("id"), 3)), ["_h", "id"])
    classes = [r["actual"] for r in numbered.orderBy("position").collect()]
    loss = 0.0
    for r in range(1, 6):
        pairs = [(classes[p["id"]], classes[p[f"p{r}"]]) for p in places]
        f1 = 0.0
        for c in "abc":
            hits = sum(a == c == b for a, b in pairs)
            both = sum(a == c for a, _ in pairs) + sum(b == c for _, b in pairs)
            f1 += 2 * hits / both * sum(a == c for a, _ in pairs) / len(pairs)
        loss += (1 - f1) / 5
    assert {r["feature"]: round(r["importance"], 9) for r in got} == {"used": round(loss, 9), "idle": 0.0}
