"""Exact quantiles against a sort."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.ml import features
from roadlens.operators import evaluation, junctions
from roadlens.operators import quantiles as exact
from roadlens.operators.quantiles import quantiles


@pytest.mark.parametrize("kind", ["wide", "ties", "one"])
def test_quantiles_match_a_sort(spark, kind):
    rng = np.random.default_rng(2)
    values = {
        "wide": np.exp(rng.normal(0, 40, 701)) * rng.choice([-1, 1], 701),
        "ties": rng.integers(0, 4, 700).astype(float),
        "one": np.full(5, 3.5),
    }[kind]
    rows = [(i % 3, float(v), None if i % 2 else float(i)) for i, v in enumerate(values)]
    table = spark.createDataFrame([*rows, (3, None, float("nan")), (None, 1.0, None)], "g int, x double, y double")
    shares = [0.0, 0.1, 0.5, 0.8, 1.0]
    for row in quantiles(table, ["x", "y"], shares, by=["g"]).collect():
        for name, at in (("x", 1), ("y", 2)):
            own = sorted(r[at] for r in rows if r[0] == row["g"] and r[at] is not None)
            if row["g"] is None and name == "x":
                own = [1.0]
            want = [own[max(1, math.ceil(round(s * len(own), 9))) - 1] if own else None for s in shares]
            assert row[name] == want
    (whole,) = quantiles(table.where("g < 3"), ["x"], [0.5]).collect()
    assert whole["x"] == [sorted(values)[math.ceil(len(values) / 2) - 1]]


def test_no_rows(spark):
    none = spark.createDataFrame([], "timestamp_seconds long, label string")
    assert quantiles(none, ["timestamp_seconds"], [0.5]).first()["timestamp_seconds"] == [None]
    assert quantiles(none, ["timestamp_seconds"], [0.5], by=["label"]).collect() == []
    assert [side.count() for side in features.time_split(none)] == [0, 0]


def test_rows_without_a_label(spark):
    rows = [(i, None if i % 5 == 0 else "ab"[i % 2]) for i in range(100)]
    table = spark.createDataFrame(rows, "id long, label string")
    train, test = features.stratified_split(table, "id", "label")
    assert train.count() + test.count() == 80
    assert train.where("label is null").count() == 0
    folds = features.with_folds(table, "id", "label")
    assert folds.where("label is null and fold is null").count() == 20
    weighted = evaluation.with_class_weight(table, "label")
    assert weighted.where("label is null and class_weight is null").count() == 20
    assert weighted.agg(F.round(F.sum("class_weight"), 6)).first()[0] == 80


def test_hour_23_stays_beside_an_unreadable_time(spark):
    rows = [(f"2024-01-01 {h:02d}:00:00", 1, 5) for h in range(24)] + [(None, 1, 5)]
    table = spark.createDataFrame(rows, "DateTime string, Junction int, Vehicles int")
    table = table.withColumn("DateTime", F.col("DateTime").cast("timestamp_ntz"))
    hours = [r["hour_of_day"] for r in junctions.hourly(junctions.label_flat(table)).collect()]
    assert hours == [None, *range(24)]


@pytest.mark.parametrize("kind", ["spread", "ties", "one value"])
def test_brackets_are_cut_down_and_settled(spark, monkeypatch, kind):
    """Coarse sketches and few ranked values, as in very large tables."""
    monkeypatch.setattr(exact, "FEW", 20)
    monkeypatch.setattr(exact, "ACCURACY", 100)
    monkeypatch.setattr(exact, "GRID", 8)
    rng = np.random.default_rng(1)
    values = {
        "spread": rng.normal(0, 1, 8000),
        "ties": rng.integers(0, 50, 8000).astype(float),
        "one value": np.concatenate((np.zeros(6000), rng.normal(0, 1, 2000))),
    }[kind]
    table = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(values)], "g int, x double")
    shares = [0.0, 0.001, 0.1, 0.5, 0.73, 0.999, 1.0]
    for row in quantiles(table, ["x"], shares, by=["g"]).collect():
        own = sorted(values[row["g"] :: 2])
        assert row["x"] == [own[max(1, math.ceil(round(s * len(own), 9))) - 1] for s in shares]


def test_a_wrong_bracket_is_opened_again(spark, monkeypatch):
    tries = []

    def brackets(long, wanted, groups, kinds):
        if not tries:  # as if the sketch had missed
            for w in wanted:
                w.low, w.high = 10.0, 20.0
        tries.append(len(wanted))
        return right(long, wanted, groups, kinds)

    right = exact._with_brackets
    monkeypatch.setattr(exact, "_with_brackets", brackets)
    table = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    assert quantiles(table, ["x"], [0.5]).first()["x"] == [49.0]
    assert tries == [1, 1]
