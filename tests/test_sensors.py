"""Edge rows of the sensor operators."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens import schemas
from roadlens.config import Settings
from roadlens.operators import reshape, sensors

START = datetime(2024, 1, 1)


def readings(spark, rows):
    return spark.createDataFrame(
        [(START + timedelta(minutes=5 * i), s, v) for i, (s, v) in enumerate(rows)],
        schemas.READINGS,
    )


def test_rolling_frame_is_thirteen_rows(spark):
    table = sensors.sensor_facts(readings(spark, [("a", float(i)) for i in range(1, 15)]))
    rows = table.orderBy("timestamp").collect()
    assert rows[13]["avg_speed_1h"] == sum(range(2, 15)) / 13
    assert rows[0]["speed_std_1h"] == 0.0
    assert rows[0]["speed_trend"] == 0.0


def test_no_anomaly_for_single_or_constant_sensor(spark):
    rows = [("one", 5.0)] + [("flat", 7.0)] * 30
    assert sensors.speed_anomalies(sensors.sensor_facts(readings(spark, rows))).count() == 0


def test_anomaly_kinds(spark):
    rows = [("a", 50.0)] * 40 + [("a", 1.0), ("a", 120.0)]
    found = sensors.speed_anomalies(sensors.sensor_facts(readings(spark, rows)))
    assert [r["anomaly_type"] for r in found.orderBy("timestamp").collect()] == [
        "sudden_slowdown", "sensor_outlier"
    ]


def test_free_flow_zero_is_no_error(spark):
    facts = sensors.sensor_facts(readings(spark, [("z", 0.0)] * 3))
    rows = sensors.speed_forecast(facts).collect()
    assert {(r["forecast_density_score"], r["forecast_congestion_level"]) for r in rows} == {
        (0.0, "low")
    }
    assert {r["congestion_level"] for r in facts.collect()} == {"low"}


def test_null_speed_stays_and_is_low(spark):
    facts = sensors.sensor_facts(readings(spark, [("a", 10.0), ("a", None), ("a", 30.0)]))
    rows = sensors.traffic_metrics(facts).orderBy("timestamp").collect()
    assert rows[1]["density_score"] == 0.0
    assert rows[1]["avg_speed_1h"] == 10.0


def test_sensor_list_repeats_and_drops(spark):
    """The list join inside the facts equals joining first and windowing then."""
    rows = [(s, float(v)) for v, s in enumerate("aababbacbaabbbaacab")]
    table = readings(spark, rows)
    listed = spark.createDataFrame([("a",), ("a",), ("b",), ("x",)], schemas.SENSORS)
    got = sensors.sensor_facts(table, Settings(), listed)
    want = sensors.sensor_facts(table.join(listed, "sensor_id"), Settings())
    columns = [c for c in want.columns if c != "sensor_std_speed"]

    def content(facts):
        return sorted((tuple(r) for r in facts.select(*columns).collect()), key=repr)

    assert content(got) == content(want)
    assert {r["sensor_id"] for r in got.collect()} == {"a", "b"}

    def deviations(facts):
        pairs = facts.select("sensor_id", "sensor_std_speed").distinct().collect()
        return dict(map(tuple, pairs))

    assert deviations(got) == pytest.approx(deviations(want))


def test_result_schemas(spark):
    facts = sensors.sensor_facts(readings(spark, [("a", 10.0), ("b", 4.0)]))
    for table, ddl in (
        (sensors.traffic_metrics(facts), schemas.METRICS),
        (sensors.congestion_alerts(facts), schemas.ALERTS),
        (sensors.speed_forecast(facts), schemas.FORECAST),
        (sensors.speed_anomalies(facts), schemas.ANOMALIES),
        (sensors.dynamic_prices(facts), schemas.PRICING),
    ):
        empty = spark.createDataFrame([], ddl)
        assert table.dtypes == empty.dtypes


def test_run_counts_match_tables(spark):
    rows = [("a", 50.0 + i % 3) for i in range(40)] + [("a", 1.0)] + [("b", 9.0)] * 5
    facts = sensors.sensor_facts(readings(spark, rows)).cache()
    got = sensors.run_counts(facts).first()
    assert got["records_processed"] == 46
    assert got["congestion_alerts"] == sensors.congestion_alerts(facts).count()
    assert got["anomalies_detected"] == sensors.speed_anomalies(facts).count() == 1


def test_unpivot_keeps_empty_cells_and_mixed_types(spark):
    wide = spark.createDataFrame(
        [("2024-01-01 00:00:00", "1", "2.5"), ("2024-01-01 00:05:00", None, "x"), ("bad", "1", "1")],
        "`first` string, `400.001` string, `s 2` string",
    )
    rows = reshape.wide_to_long(wide).orderBy("timestamp", "sensor_id").collect()
    assert [(r["sensor_id"], r["speed"]) for r in rows] == [
        ("400.001", 1.0), ("s 2", 2.5), ("400.001", None), ("s 2", None)
    ]


def test_medians(spark):
    table = spark.createDataFrame(
        [(1.0, None, 1), (3.0, None, None), (None, None, 2)], "a double, b double, c int"
    )
    rows = reshape.fill_medians(table, ["a", "b", "c"]).collect()
    assert [r["a"] for r in rows] == [1.0, 3.0, 1.0]
    assert [r["b"] for r in rows] == [0.0] * 3
    assert [r["c"] for r in rows] == [1, 1, 2]


def test_required_columns_named(spark):
    with pytest.raises(ValueError, match="b, c"):
        reshape.require_columns(spark.range(1).withColumnRenamed("id", "a"), ["a", "c", "b"])


def test_constants_and_drops(spark):
    table = spark.createDataFrame([(None, None), (1.0, "x")], "n double, s string")
    filled = reshape.fill_constants(table, numbers=["n"], texts=["s"])
    assert [tuple(r) for r in filled.collect()] == [(0.0, "Unknown"), (1.0, "x")]
    assert reshape.keep_known(table).count() == 1


def test_profile_in_two_levels(spark):
    """Rows of a sensor in many tasks: merged figures are those of all rows, the sketch exact up to its size."""
    rng = np.random.default_rng(4)
    rows = [("hot", float(v)) for v in rng.normal(50, 9, 3000).round(3)] + [("cold", 7.0), ("gap", None), ("gap", 3.0), ("none", None)]
    table = readings(spark, rows).repartition(12)
    got = {r["sensor_id"]: r for r in sensors.sensor_profile(table, Settings(task_groups=5)).collect()}
    speeds = np.array([v for s, v in rows if s == "hot"])
    hot = got["hot"]
    assert hot["free_flow_speed"] == np.sort(speeds)[math.ceil(0.95 * len(speeds)) - 1]
    assert hot["sensor_mean_speed"] == pytest.approx(speeds.mean()) and hot["n"] == hot["known"] == 3000
    assert hot["sensor_std_speed"] == pytest.approx(speeds.std(ddof=1))
    assert hot["latest"]["speed"] == rows[2999][1]
    assert (got["cold"]["free_flow_speed"], got["cold"]["sensor_std_speed"]) == (7.0, 0.0)
    assert (got["gap"]["free_flow_speed"], got["gap"]["known"], got["gap"]["n"]) == (3.0, 1, 2)
    assert (got["none"]["free_flow_speed"], got["none"]["sensor_mean_speed"], got["none"]["known"]) == (None, None, 0)


def test_free_flow_beyond_the_sketch(spark):
    rows = readings(spark, [("a", float(v)) for v in range(20_000)]).repartition(6)
    found = sensors.sensor_profile(rows, Settings(free_flow_sketch=400, task_groups=3)).first()["free_flow_speed"]
    assert abs(found / 20_000 - 0.95) < 0.03
