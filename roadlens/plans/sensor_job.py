"""Sensor readings to five result tables and a run summary; routes; dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens import schemas
from roadlens.config import DEFAULTS, DatasetLayout, Settings
from roadlens.operators import routing, sensors
from roadlens.operators.lineage import staging
from roadlens.sources import readers, sinks


def result_tables(facts: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    return {
        "traffic_metrics.parquet": sensors.traffic_metrics(facts),
        "congestion_alerts.parquet": sensors.congestion_alerts(facts),
        "traffic_forecast.parquet": sensors.speed_forecast(facts, settings),
        "anomalies.parquet": sensors.speed_anomalies(facts, settings),
        "pricing_recommendations.parquet": sensors.dynamic_prices(facts),
    }


# Field of the run summary -> table it counts.
COUNTED = {
    "records_processed": "traffic_metrics.parquet",
    "congestion_alerts": "congestion_alerts.parquet",
    "forecast_records": "traffic_forecast.parquet",
    "anomalies_detected": "anomalies.parquet",
    "pricing_records": "pricing_recommendations.parquet",
}


def run(
    spark: SparkSession,
    layout: DatasetLayout,
    output: str,
    settings: Settings = DEFAULTS,
    day: str | None = None,
) -> DataFrame:
    """Write all result tables and ``summary.json`` under ``output``; returns the summary row.

    The text is parsed once, the sensors are profiled once, and grouping and windows run once, each into a
    staged table that is removed at the end. The last is laid out by day and sensor, so every result is a
    narrow scan of it, written by day with sensors together. The profile's stored size also lets Spark
    decide on a broadcast before it shuffles any reading. With ``day`` only that day's folders are
    replaced; windows still reach into the days before it. The summary counts all that is there then.
    """
    with staging(spark) as stage:
        readings = stage(readers.sensor_readings(spark, layout))
        listed = readers.sensor_list(spark, layout)
        profile = stage(sensors.sensor_profile(readings, settings, listed))
        facts = sensors.sensor_facts(readings, settings, profile=profile)
        if day is not None:
            facts = facts.where(F.to_date("timestamp") == F.lit(day).cast("date"))
        line = ["_day", "sensor_id", "timestamp"]
        facts = facts.withColumn("_day", F.to_date("timestamp"))
        facts = stage(facts.repartitionByRange(*line).sortWithinPartitions(*line).drop("_day"))
        for name, table in result_tables(facts, settings).items():
            sinks.write_days(table, f"{output}/{name}", only_these=day is not None)
    counts = {
        field: sinks.rows_written(spark, f"{output}/{name}", schemas.RESULT_TABLES[name])
        for field, name in COUNTED.items()
    }
    alerts = readers.result_table(spark, output, "congestion_alerts.parquet")
    summary = run_summary(spark, layout.dataset, counts, sensors.top_sensors(alerts))
    sinks.write_document(summary, f"{output}/summary.json")
    return spark.read.schema(summary.schema).json(f"{output}/summary.json")


def run_summary(
    spark: SparkSession, dataset: str, counts: dict[str, int], top: DataFrame
) -> DataFrame:
    """One row: dataset, the five counts, and the top sensors, most events first."""
    ranked = top.select((-F.col("events")).alias("rank"), "sensor_id", "events")
    row = sinks.document(spark, {"dataset": dataset, **counts}, {"top": ranked})
    named = F.transform("top", lambda s: F.struct(s["sensor_id"], s["events"]))
    return row.withColumn("top_congested_sensors", named).drop("top")


def routes(
    spark: SparkSession, layout: DatasetLayout, pairs: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Cheapest routes for a table of (source, target) under the latest congestion."""
    readings = readers.sensor_readings(spark, layout)
    latest = routing.latest_congestion(readings, settings, readers.sensor_list(spark, layout))
    return routing.least_cost_routes(pairs, readers.road_edges(spark, layout), latest)


def dashboard(spark: SparkSession, output: str, sensor_id: str | None = None):
    """Tables behind the dashboard, from the written results; missing results give empty tables."""

    def table(name: str) -> DataFrame:
        return readers.result_table(spark, output, name)

    metrics, forecast = table("traffic_metrics.parquet"), table("traffic_forecast.parquet")
    prices, anomalies = table("pricing_recommendations.parquet"), table("anomalies.parquet")
    first = forecast.agg(F.min("sensor_id")).scalar()
    return {
        "most_congested_now": sensors.most_congested_now(metrics),
        "sensor_choices": sensors.sensor_choices(forecast),
        "sensor_history": sensors.sensor_history(
            readers.result_table(spark, output, "traffic_forecast.parquet", sensor_id=sensor_id or first), sensor_id or first
        ),
        "parking_fee_distribution": sensors.parking_fee_distribution(prices),
        "top_charges": sensors.top_charges(prices),
        "latest_anomalies": sensors.latest_anomalies(anomalies),
    }
