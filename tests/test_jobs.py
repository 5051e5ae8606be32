"""The jobs end to end on small files."""

import json
import random
import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import REQUEST

from roadlens import schemas
from roadlens.config import DatasetLayout
from roadlens.ml import scoring, training
from roadlens.operators import requests
from roadlens.plans import reports, sensor_job, training_jobs
from roadlens.sources import readers, sinks
from roadlens.streaming import alerts

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    rng = random.Random(11)
    root = tmp_path_factory.mktemp("data")
    folder = root / "city"
    folder.mkdir()
    lines = ["when,s1,s2,s3,extra"]
    for i in range(60):
        speeds = [rng.choice(["", f"{rng.uniform(5, 60):.1f}", "40"]) for _ in range(4)]
        lines.append(f"{START + timedelta(minutes=20 * i)},{','.join(speeds)}")
    (folder / "sensor-readings.csv").write_text("\n".join(lines))
    (folder / "sensors.txt").write_text("s1\ns2\ns3\n")
    (folder / "distances.csv").write_text("from,to,cost\ns1,s2,100.5\ns2,s3,50\ns1,s3,900\n")
    return DatasetLayout(str(root), "city")


@pytest.fixture(scope="module")
def output(spark, dataset, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("out"))
    summary = sensor_job.run(spark, dataset, folder)
    assert summary.count() == 1
    return folder


def test_sensor_job_writes_tables_and_summary(spark, output):
    summary = readers.run_summary(spark, output).first()
    assert summary["dataset"] == "city"
    for field, name in sensor_job.COUNTED.items():
        table = readers.result_table(spark, output, name)
        assert table.count() == summary[field]
        assert table.columns == schemas.column_names(schemas.RESULT_TABLES[name])
    assert summary["records_processed"] == 180
    top = summary["top_congested_sensors"]
    assert sum(t["events"] for t in top) == summary["congestion_alerts"]
    assert [t["events"] for t in top] == sorted((t["events"] for t in top), reverse=True)
    (part,) = Path(output, "summary.json").glob("part-*")
    assert json.loads(part.read_text())["records_processed"] == 180


def test_dashboard_tables(spark, output, tmp_path):
    tables = sensor_job.dashboard(spark, output, "s2")
    assert tables["sensor_history"].count() == 60
    assert [r["sensor_id"] for r in tables["sensor_choices"].collect()] == ["s1", "s2", "s3"]
    assert tables["most_congested_now"].count() == 3
    assert tables["top_charges"].count() == 20
    empty = sensor_job.dashboard(spark, str(tmp_path))
    assert {t.count() for t in empty.values()} == {0}
    assert readers.run_summary(spark, str(tmp_path)) is None


def content(spark, output):
    return {
        name: sorted(map(repr, readers.result_table(spark, output, name).collect()))
        for name in schemas.RESULT_TABLES
    }


def files_by_day(output, name):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(output, name).glob("day=*")}


def test_one_day_again_leaves_the_others(spark, dataset, output, tmp_path):
    """60 readings every 20 minutes lie in one day and the next."""
    folder = str(tmp_path / "again")
    sensor_job.run(spark, dataset, folder)
    first = START.date()
    before = files_by_day(folder, "traffic_metrics.parquet")
    sensor_job.run(spark, dataset, folder, day=str(first))
    after = files_by_day(folder, "traffic_metrics.parquet")
    assert set(before) == set(after)
    assert {d for d in before if before[d] != after[d]} == {f"day={first}"}
    assert content(spark, folder) == content(spark, output)
    assert readers.run_summary(spark, folder).first() == readers.run_summary(spark, output).first()
    other = str(tmp_path / "empty")
    sensor_job.run(spark, dataset, other, day="1999-01-01")  # no rows at all
    assert set(map(len, content(spark, other).values())) == {0}


def test_readers_of_one_day_and_sensor_pass_over_the_rest(spark, output):
    first = str(START.date())
    table = readers.result_table(spark, output, "traffic_forecast.parquet", (first, first), "s2")
    every = readers.result_table(spark, output, "traffic_forecast.parquet")
    want = every.where((F.to_date("timestamp") == F.lit(first).cast("date")) & (F.col("sensor_id") == "s2"))
    assert sorted(table.collect()) == sorted(want.collect()) and table.columns == every.columns
    plan = table._jdf.queryExecution().executedPlan().toString()
    filters = {line.split(":")[0].strip(): line for line in re.split(r", (?=\w+: )|\n", plan)}
    assert "day" in filters["PartitionFilters"] and "sensor_id,s2" in filters["PushedFilters"]
    # Sensors stand together in every file.
    for path in Path(output, "traffic_metrics.parquet").glob("day=*/*.parquet"):
        own = [r["sensor_id"] for r in spark.read.parquet(str(path)).collect()]
        assert own == sorted(own)


def test_route_job(spark, dataset):
    pairs = spark.createDataFrame([("s1", "s3"), ("s3", "s1")], "source string, target string")
    rows = {r["source"]: r for r in sensor_job.routes(spark, dataset, pairs).collect()}
    assert rows["s1"]["path"] == ["s1", "s2", "s3"]
    assert rows["s1"]["distance_meters"] == 150.5
    assert rows["s3"]["error"]


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.junction_counts(spark, str(tmp_path / "none.csv"))
    (tmp_path / "bad.csv").write_text("DateTime,Junction\n2024-01-01,1\n")
    with pytest.raises(ValueError, match="Vehicles"):
        readers.junction_counts(spark, str(tmp_path / "bad.csv"))


@pytest.fixture(scope="module")
def counts(spark, tmp_path_factory):
    rng = random.Random(2)
    path = tmp_path_factory.mktemp("counts") / "counts.csv"
    lines = ["DateTime,Junction,Vehicles,ID"]
    for i in range(300):
        for junction in (1, 2):
            hour = i % 24
            vehicles = int(20 * junction + 25 * (hour in (8, 9, 17)) + rng.randrange(6))
            lines.append(f"{START + timedelta(hours=i)},{junction},{vehicles},{i}{junction}")
    path.write_text("\n".join(lines))
    return readers.junction_counts(spark, str(path))


def test_junction_reports(spark, counts, tmp_path):
    summary = reports.junction_summary(counts)
    overall = summary["overall"].first()
    assert overall["records"] == 600
    assert overall["total_vehicles"] == counts.agg(F.sum("Vehicles")).first()[0]
    assert summary["hourly"].count() == 12
    hours = summary["hours_to_travel"].first()
    assert hours["highest_hour_of_day"] in (8, 9, 17)
    report = reports.junction_report(counts)
    assert report["dataset_range"].first()["covered_seconds"] == 299 * 3600
    assert report["junction_extremes"].first()["lowest_Junction"] == 1
    assert report["most_congested_band"].first()["time_band"] == "Peak Hour"
    assert report["bands_and_levels"].agg(F.sum("records")).first()[0] == 600
    assert report["quietest_routes"].count() == 10
    reports.write_tables({"hourly": report["hourly"]}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "hourly")).count() == 24


@pytest.fixture(scope="module")
def conditions(spark, tmp_path_factory):
    rng = random.Random(4)
    path = tmp_path_factory.mktemp("roads") / "roads.csv"
    texts = ["sky is clear", "broken clouds", "light rain", "thunderstorm", "fog", ""]
    lines = ["date_time,id,air_pollution_index,humidity,visibility_in_miles,temperature,rain_p_h,"
             "snow_p_h,traffic_volume,weather_type,weather_description"]
    for i in range(600):
        lines.append(
            f"{START + timedelta(hours=i)},{i},{rng.randrange(300)},{rng.randrange(100)},"
            f"{rng.choice(['', *range(8)])},{rng.randrange(260, 310)},0,0,{rng.randrange(7500)},"
            f"{rng.choice(['Clouds', 'Rain'])},{rng.choice(texts)}"
        )
    path.write_text("\n".join(lines))
    return readers.road_conditions(spark, str(path)).withColumn("id", F.col("id").cast("int"))


def test_risk_reports(conditions):
    summary = reports.risk_summary(conditions, ["id"])
    assert summary["levels"].agg(F.sum("records")).first()[0] == 600
    assert summary["first_transitions"].count() == 10
    report = reports.risk_intelligence(conditions, ["id"])
    assert report["hours_and_levels"].agg(F.sum("records")).first()[0] == 600
    assert report["first_rows"].count() == 10
    assert report["rows"].where("risk_reason is null").count() == 0


@pytest.fixture(scope="module")
def mix(spark, tmp_path_factory):
    rng = random.Random(6)
    path = tmp_path_factory.mktemp("mix") / "mix.csv"
    lines = ["Time,Date,Day of the week,CarCount,BikeCount,BusCount,TruckCount,Total,Traffic Situation"]
    for i in range(400):
        when = START + timedelta(minutes=15 * i)
        cars, bikes, buses, trucks = (rng.randrange(n) for n in (120, 30, 20, 20))
        total = cars + bikes + buses + trucks
        name = "heavy" if total > 120 else "high" if total > 90 else "normal" if total > 50 else "low"
        lines.append(f"{when:%I:%M:%S %p},{i},{when:%A},{cars},{bikes},{buses},{trucks},{total},{name}")
    path.write_text("\n".join(lines))
    return readers.vehicle_mix(spark, str(path))


def test_vehicle_report(mix):
    tables = reports.vehicle_report(mix)
    total = tables["totals"].first()
    assert total["records"] == 400
    assert tables["composition"].agg(F.round(F.sum("share_percent"), 6)).first()[0] == 100.0
    assert tables["daily_trend"].count() == 96


def test_demand_job(spark, counts, tmp_path):
    fitted = training_jobs.demand(counts, str(tmp_path), ["ID"], trees=5, depth=5)
    written = spark.read.parquet(str(tmp_path / "predictions"))
    assert written.count() == fitted.predictions.count() > 0
    assert fitted.metrics.first()["r2"] > 0.5
    assert spark.read.parquet(str(tmp_path / "residuals")).agg(F.sum("n")).first()[0] == written.count()
    again = sinks.load_model(str(tmp_path / "forecaster")).transform(fitted.predictions.drop(
        "prediction", "features", "Junction_index", "Junction_encoded"))
    assert again.count() == written.count()


def test_situation_job(spark, mix, tmp_path):
    winner = training_jobs.situation(
        mix, "Date", str(tmp_path), trees=5, depth=4, rounds=2, boosted_depth=2
    )
    table = spark.read.option("header", True).csv(str(tmp_path / "model_comparison.csv"))
    assert table.count() == 2
    document = spark.read.json(str(tmp_path / "metrics_summary.json")).first()
    assert document["best_model"] == winner.name
    assert len(document["models"][0]["confusion_matrix"]) == 16
    names = [r["feature"] for r in spark.read.parquet(str(tmp_path / "importances")).collect()]
    assert "Total" in names


def test_risk_job(spark, conditions, tmp_path):
    winner = training_jobs.risk(
        conditions, "id", str(tmp_path), repeats=1, trees=5, logistic_rounds=10, boosted=False
    )
    samples = spark.read.option("header", True).csv(str(tmp_path / "sample_predictions.csv"))
    assert samples.count() == 15 and {"actual_label", "predicted_label"} <= set(samples.columns)
    document = spark.read.json(str(tmp_path / "metrics_summary.json")).first()
    assert 0.5 < document["roc_auc"][0]["roc_auc_ovr_weighted"] <= 1.0
    assert len(document["feature_importance_top20"]) <= 20
    facts = sinks.model_facts(spark, str(tmp_path / "best_model")).first()
    assert facts["model_name"] == winner.name and "Low" in facts["target_labels"]


def test_request_models_are_trained_once(spark, counts, mix, conditions, tmp_path):
    args = (spark, str(tmp_path), counts, mix, conditions, ("ID", "Date", "id"))
    small = {"volume": 4, "situation": 4, "risk": 4}
    loaded = training_jobs.request_models(*args, small)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(training, "train_small_risk", None)
        training_jobs.request_models(*args, small)
    facts = sinks.model_facts(spark, str(tmp_path / "risk")).first()
    assert facts["model_type"] == "classification" and facts["target_name"] == "risk_level"
    raw = spark.createDataFrame([{"id": 1, **{k: str(v) for k, v in REQUEST.items()}}])
    valid = requests.validate(raw).drop("errors")
    answers = scoring.compare_requests(valid, "id", **loaded).collect()
    assert [a["model_name"] for a in answers] == [n for n, _ in scoring.MODEL_NAMES.values()]
    assert all(0.0 <= a["confidence_score"] <= 1.0 for a in answers)


def test_streamed_alerts_equal_batch(spark, tmp_path):
    rows = [(START + timedelta(minutes=i), f"s{i % 3}", float(i % 50)) for i in range(200)]
    readings = spark.createDataFrame(rows, schemas.READINGS)
    readings.repartition(4).write.parquet(str(tmp_path / "in"))
    free_flow = spark.createDataFrame([("s0", 50.0), ("s1", 20.0)], "sensor_id string, free_flow_speed double")
    stream = alerts.live_alerts(alerts.reading_files(spark, str(tmp_path / "in"), 1), free_flow)
    query = alerts.write_alerts(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = alerts.live_alerts(readings, free_flow)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0


def test_reports_do_not_depend_on_partitions(spark):
    """Many rows of one time, default arguments, two partitionings: equal rows."""
    table = spark.range(400).select(
        F.date_trunc("day", F.timestamp_seconds(F.col("id") * 7_000)).cast("timestamp_ntz").alias("date_time"),
        (F.col("id") * 37 % 6_000).cast("double").alias("traffic_volume"),
        (F.col("id") * 53 % 300).cast("double").alias("air_pollution_index"),
        (F.col("id") % 7).cast("double").alias("visibility_in_miles"),
        F.element_at(F.array(F.lit("fog"), F.lit("light rain"), F.lit("sky is clear")), (F.col("id") % 3 + 1).cast("int")).alias("weather_description"),
        F.lit("Clouds").alias("weather_type"),
        (F.col("id") % 101).cast("double").alias("humidity"),
        (F.col("id") % 40 + 270).cast("double").alias("temperature"),
        (F.col("id") % 5).cast("double").alias("rain_p_h"),
        (F.col("id") % 2).cast("double").alias("snow_p_h"),
    )
    for report in (reports.risk_summary, reports.risk_intelligence):
        one, many = (report(table.repartition(n))["transitions"].collect() for n in (1, 7))
        assert sorted(map(repr, one)) == sorted(map(repr, many)) and one
