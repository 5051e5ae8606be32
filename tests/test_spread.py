"""Rows of small files reach all cores when forests are fitted and asked."""

import pytest
from pyspark.sql import functions as F

from roadlens.ml import models, scoring, training
from roadlens.operators.reshape import spread


class _Seen(Exception):
    """Ends a job with the number of partitions a model was to be fitted on."""


class _Stop:
    def fit(self, rows):
        raise _Seen(rows.rdd.getNumPartitions(), rows.count())


def _seen(job, *inputs):
    with pytest.raises(_Seen) as seen:
        job(*inputs)
    return seen.value.args


@pytest.fixture(scope="module")
def counts(spark):
    rows = spark.range(0, 60_000, 1, 1)
    return rows.select(
        F.col("id").alias("ID"),
        (F.timestamp_seconds(F.col("id") * 600)).cast("timestamp_ntz").alias("DateTime"),
        (F.col("id") % 3).cast("int").alias("Junction"),
        (F.col("id") * 7 % 50).cast("int").alias("Vehicles"),
    ).cache()


def test_spread_keeps_rows_and_leaves_small_tables(spark):
    rows = spark.range(0, 30_000, 1, 1).withColumn("copy", F.col("id") % 2).drop("id")
    dealt = spread(rows)
    assert 2 <= dealt.rdd.getNumPartitions() <= 6
    assert {r["copy"]: r["count"] for r in dealt.groupBy("copy").count().collect()} == {0: 15_000, 1: 15_000}
    assert spread(rows.limit(9_000)).rdd.getNumPartitions() == 1


def test_volume_forests_use_several_tasks(counts, monkeypatch):
    monkeypatch.setattr(models, "volume_forecaster", lambda *a: _Stop())
    monkeypatch.setattr(models, "small_volume_forest", lambda *a: _Stop())
    parts, n = _seen(training.train_volume, counts.coalesce(1), ["ID"])
    assert parts > 1 and n == pytest.approx(48_000, abs=200)
    parts, n = _seen(training.train_small_volume, counts.coalesce(1), "ID")
    assert parts > 1 and n == pytest.approx(48_000, rel=0.02)


def _roads(spark, n):
    return spark.range(0, n, 1, 1).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("date_time"),
        *[(F.col("id") * k % 300).cast("double").alias(name) for k, name in enumerate(
            ("traffic_volume", "air_pollution_index", "humidity", "visibility_in_miles", "temperature",
             "rain_p_h", "snow_p_h"), 3)],
        F.lit("Clouds").alias("weather_type"),
        F.when(F.col("id") % 2 == 0, "fog").otherwise("light rain").alias("weather_description"),
    )


def test_risk_forests_use_several_tasks(spark, monkeypatch):
    roads = _roads(spark, 30_000)
    monkeypatch.setattr(models, "small_risk_forest", lambda *a: _Stop())
    monkeypatch.setattr(models, "risk_forest", lambda *a: _Stop())
    parts, n = _seen(training.train_small_risk, roads, "event_id")
    assert parts > 1 and n == pytest.approx(24_000, abs=10)
    monkeypatch.setattr(models, "risk_logistic", lambda *a: type("Quick", (), {"fit": lambda self, rows: None})())
    parts, _ = _seen(lambda: training.train_risk(roads, "event_id", boosted=False))
    assert parts > 1


def test_deep_forests_remember_nodes():
    for pipeline in (models.small_risk_forest(3), models.risk_forest(trees=3)):
        forest = pipeline.getStages()[-1]
        assert forest.getCacheNodeIds() and forest.getMaxDepth() == models.DEEP


def test_volume_answers_once_per_set_of_inputs(spark, counts, monkeypatch):
    data = counts.where("ID < 2000").select(
        F.hour("DateTime").alias("hour"), F.col("Junction").alias("junction"), F.col("Vehicles").cast("double").alias("Vehicles")
    )
    model = models.small_volume_forest(trees=5, depth=4).fit(data)
    asked = spark.createDataFrame(
        [(i, i % 2, None if i % 5 == 0 else 1) for i in range(500)], "id int, hour int, junction int"
    )
    plain = scoring.with_votes(model.stages[-1], model.stages[0].transform(asked), "votes")
    want = {r["id"]: r["prediction"] for r in plain.select("id", "prediction").collect()}
    scored, sizes = scoring.with_votes, []

    def counted(forest, rows, votes="votes"):
        sizes.append(rows.count())
        return scored(forest, rows, votes)

    monkeypatch.setattr(scoring, "with_votes", counted)
    got = scoring.volume_with_confidence(model, asked).collect()
    assert sizes == [4]
    assert {r["id"]: r["prediction"] for r in got} == pytest.approx(want) and len(got) == 500
    assert not [r for r in got if r["confidence_score"] is None]


def test_requests_are_dealt_before_they_are_scored(spark, monkeypatch):
    seen = []

    def stop(model, rows):
        seen.append(rows.rdd.getNumPartitions())
        raise _Seen

    monkeypatch.setattr(scoring, "volume_with_confidence", stop)
    monkeypatch.setattr(scoring, "staged", lambda rows: rows)
    with pytest.raises(_Seen):
        scoring.compare_requests(spark.range(0, 30_000, 1, 1), "id", None, None, None)
    assert seen[0] > 1


def test_requests_are_computed_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(n):
        made.add(1)
        return n

    monkeypatch.setattr(scoring, "volume_with_confidence", lambda model, rows: _raise(rows.select("id").distinct().count()))
    with pytest.raises(_Seen):
        scoring.compare_requests(spark.range(0, 20_000, 1, 1).select(seen("id").alias("id")), "id", None, None, None)
    assert made.value == 20_000


def _raise(*args):
    raise _Seen(*args)
