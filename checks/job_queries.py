"""File readers and writers, whole jobs and the alert stream, over files Spark derives from the
test tables into the shared checkpoint folder."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.ml_queries import _risk, _risk_sql
from checks import summary_queries
from checks.sensor_queries import (
    _ALERTS, _ANOMALIES, _BASE, _FORECAST, _METRICS, _PRICES, _TREND, rounded,
)
from checks.summary_queries import (
    hour_level_table,
    _FLAT_WITH, _MIX_WITH, _PEAK_WITH, _TOTALS, _TRANSITIONS, _mix, _scored, risk_with,
)
from checks.views import VIEWS, half_up, view, with_views
from roadlens.config import DatasetLayout
from roadlens.functions import scalars
from roadlens.ml import models, training
from roadlens.operators import roads, sensors
from roadlens.operators.lineage import new_folder, staged
from roadlens.plans import reports, sensor_job, training_jobs
from roadlens.sources import readers, sinks
from roadlens.streaming import alerts

_LISTED = ("click", "error", "view")


def _dataset(spark: SparkSession, folder: str) -> DatasetLayout:
    """The three input files of one sensor dataset; the event types are the sensors."""
    layout = DatasetLayout(new_folder(spark, "dataset"), "events")
    wide = view(spark, folder, "readings_wide")
    sinks.write_csv(wide.withColumnRenamed("timestamp", "when"), layout.readings)
    types = spark.read.parquet(f"{folder}/events.parquet").select("event_type").distinct()
    types.where(F.col("event_type").isin(*_LISTED)).write.text(layout.sensors)
    edges = view(spark, folder, "distances").toDF("from", "to", "cost")
    sinks.write_csv(edges, layout.distances)
    return layout


def file_readings(spark, folder):
    layout = _dataset(spark, folder)
    return rounded(readers.sensor_readings(spark, layout), 8, "speed")


def file_sensors(spark, folder):
    return readers.sensor_list(spark, _dataset(spark, folder))


def file_edges(spark, folder):
    return readers.road_edges(spark, _dataset(spark, folder))


def file_junctions(spark, folder):
    path = new_folder(spark, "junctions")
    sinks.write_csv(view(spark, folder, "junction_counts"), path)
    return readers.junction_counts(spark, path).withColumn("ID", F.col("ID").cast("long"))


def file_roads(spark, folder):
    path = new_folder(spark, "roads")
    table = view(spark, folder, "road_conditions")
    # The CSV reader drops blanks around a value only if told to; the file keeps them.
    table.withColumn("date_time", F.col("date_time").cast("string")).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return readers.road_conditions(spark, path).withColumn("event_id", F.col("event_id").cast("long"))


def file_vehicles(spark, folder):
    path = new_folder(spark, "vehicles")
    named = {"DayOfWeek": "Day of the week", "TrafficSituation": "Traffic Situation"}
    sinks.write_csv(_mix(spark, folder).drop("slot").withColumnsRenamed(named), path)
    return readers.vehicle_mix(spark, path)


def _job(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    output = new_folder(spark, "results")
    return output, sensor_job.run(spark, _dataset(spark, folder), output)


def sensor_job_summary(spark, folder):
    _, summary = _job(spark, folder)
    tops = F.transform("top_congested_sensors", lambda s: F.concat_ws(":", s.sensor_id, s.events))
    return summary.withColumn("top_congested_sensors", F.concat_ws(",", tops))


def _job_table(name: str):
    def query(spark, folder):
        output, _ = _job(spark, folder)
        return readers.result_table(spark, output, name)

    return query


def sensor_job_alerts(spark, folder):
    return _job_table("congestion_alerts.parquet")(spark, folder)


def sensor_job_prices(spark, folder):
    return _job_table("pricing_recommendations.parquet")(spark, folder)


def sensor_job_metrics(spark, folder):
    table = _job_table("traffic_metrics.parquet")(spark, folder)
    return rounded(table, 6, "speed", "free_flow_speed", "avg_speed_1h", "speed_std_1h", "density_proxy")


def sensor_job_forecast(spark, folder):
    return rounded(_job_table("traffic_forecast.parquet")(spark, folder), 6, "speed")


def sensor_job_anomalies(spark, folder):
    table = _job_table("anomalies.parquet")(spark, folder)
    return rounded(table, 6, "speed", "avg_speed_1h", "speed_zscore")


def _dashboard(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    output, _ = _job(spark, folder)
    return sensor_job.dashboard(spark, output)


def dashboard_most_congested(spark, folder):
    tables = _dashboard(spark, folder)
    return tables["most_congested_now"].select("sensor_id", "timestamp", "density_score")


def dashboard_choices(spark, folder):
    return _dashboard(spark, folder)["sensor_choices"]


def dashboard_history(spark, folder):
    return rounded(_dashboard(spark, folder)["sensor_history"], 6, "speed")


def dashboard_fees(spark, folder):
    return rounded(_dashboard(spark, folder)["parking_fee_distribution"], 6, "q1_fee", "median_fee", "q3_fee")


def dashboard_charges(spark, folder):
    return _dashboard(spark, folder)["top_charges"]


def dashboard_anomalies(spark, folder):
    return rounded(_dashboard(spark, folder)["latest_anomalies"], 6, "speed", "avg_speed_1h", "speed_zscore")


# Report jobs: tables as files, read back.


def _vehicle_table(name: str, *round_to_8: str):
    def query(spark, folder):
        output = new_folder(spark, "vehicle-report")
        reports.write_tables(reports.vehicle_report(_mix(spark, folder)), output)
        return rounded(spark.read.parquet(f"{output}/{name}"), 8, *round_to_8)

    return query


def _intelligence_table(name: str):
    def query(spark, folder):
        output = new_folder(spark, "risk-intelligence")
        reports.write_tables(reports.risk_intelligence(view(spark, folder, "road_conditions"), ["event_id"]), output)
        return spark.read.parquet(f"{output}/{name}")

    return query


def risk_job_rows(spark, folder):
    return _intelligence_table("rows")(spark, folder).select("event_id", "hour", "rush_hour", "risk_level", "risk_reason")


def risk_job_levels(spark, folder):
    table = _intelligence_table("hours_and_levels")(spark, folder)
    return table.select("hour", "risk_level", "records", *[
        F.round(c, 8).alias(c) for c in ("avg_traffic_volume", "avg_total_risk_score")
    ])


def risk_job_transitions(spark, folder):
    table = _intelligence_table("first_transitions")(spark, folder)
    return table.select("event_id", "risk_level", "previous_risk_level")


def alert_counts(spark, folder):
    facts = sensors.sensor_facts(
        view(spark, folder, "readings"), sensors=view(spark, folder, "sensors")
    )
    return sensors.alert_counts(sensors.congestion_alerts(facts))


def streamed_alerts(spark, folder):
    """Alerts of a stream of reading files against the free-flow table of the same readings."""
    source, output = new_folder(spark, "arrivals"), new_folder(spark, "alerts")
    readings = view(spark, folder, "readings")
    readings.write.parquet(source)
    free_flow = staged(sensors.sensor_profile(readings))
    stream = alerts.live_alerts(alerts.reading_files(spark, source), free_flow)
    alerts.write_alerts(stream, output, new_folder(spark, "progress")).awaitTermination()
    return spark.read.parquet(output)


def junction_summary_hourly(spark, folder):
    return reports.junction_summary(view(spark, folder, "junction_counts"))["hourly"]


def junction_report_junctions(spark, folder):
    return reports.junction_report(view(spark, folder, "junction_counts"))["junctions"]


def junction_report_bands(spark, folder):
    return reports.junction_report(view(spark, folder, "junction_counts"))["bands_and_levels"]


def risk_summary_levels(spark, folder):
    table = reports.risk_summary(view(spark, folder, "road_conditions"), ["event_id"])["levels"]
    means = [c for c in table.columns if c.startswith("avg_")]
    return rounded(table, 8, *means)


def risk_summary_first_transitions(spark, folder):
    tables = reports.risk_summary(view(spark, folder, "road_conditions"), ["event_id"])
    return tables["first_transitions"]


def first_hour_level_rows(spark, folder):
    table = hour_level_table(_scored(spark, folder, "report"))
    first = table.orderBy("hour", "risk_level").limit(10)
    return rounded(first, 8, "avg_traffic", "avg_visibility", "avg_weather", "avg_risk")


def normalized_texts(spark, folder):
    table = view(spark, folder, "road_conditions")
    text = scalars.plain_text(F.col("weather_description"))
    return table.select("event_id", text.alias("weather_description"))


def standardised_features(spark, folder):
    """The assembled, scaled and one-hot encoded inputs of the risk models."""
    rows = _risk(spark, folder)
    numbers, texts = ["humidity", "temperature"], ["weather_type"]
    fitted = Pipeline(stages=models.scaled_inputs(numbers, texts)).fit(rows)
    vector = vector_to_array("features")
    codes = F.transform(F.slice(vector, 3, 100), lambda x: x.cast("int").cast("string"))
    return fitted.transform(rows).select(
        "event_id",
        F.round(vector[0], 6).alias("humidity"),
        F.round(vector[1], 6).alias("temperature"),
        F.concat_ws(",", codes).alias("weather_type"),
    )


def train_imputed(spark, folder):
    conditions = view(spark, folder, "road_conditions")
    numbers = ["visibility_in_miles", "air_pollution_index"]
    texts = ["weather_description"]
    (filled,) = training.impute_from_train(conditions, [], numbers, texts)
    return filled.select("event_id", *numbers, "weather_description")


def saved_model_predictions(spark, folder):
    """A forecaster saved, found again instead of being trained, and applied."""
    output = new_folder(spark, "demand")
    fitted = training_jobs.demand(
        view(spark, folder, "junction_counts"), output, ["ID"], trees=5, depth=5
    )
    model = sinks.model_or_train(spark, f"{output}/forecaster", lambda: None)
    inputs = [c for c in fitted.predictions.columns if c in ("ID", "Junction", "Vehicles")]
    kept = fitted.predictions.select(
        *inputs, "DateTime", *training.features.VOLUME_INPUTS
    )
    return model.transform(kept).select(*inputs, "prediction")


def situation_job_document(spark, folder):
    output = new_folder(spark, "situation")
    training_jobs.situation(
        _mix(spark, folder), "slot", output, trees=5, depth=4, rounds=1, boosted_depth=2
    )
    return spark.read.json(f"{output}/metrics_summary.json").select(
        "best_model", F.col("models")[0]["metrics"].alias("metrics")
    )


QUERIES = {
    f.__name__: f
    for f in (
        file_readings,
        file_sensors,
        file_edges,
        file_junctions,
        file_roads,
        file_vehicles,
        sensor_job_summary,
        sensor_job_alerts,
        sensor_job_prices,
        sensor_job_metrics,
        sensor_job_forecast,
        sensor_job_anomalies,
        dashboard_most_congested,
        dashboard_choices,
        dashboard_history,
        dashboard_fees,
        dashboard_charges,
        dashboard_anomalies,
        risk_job_rows,
        risk_job_levels,
        risk_job_transitions,
        alert_counts,
        streamed_alerts,
        junction_summary_hourly,
        junction_report_junctions,
        junction_report_bands,
        risk_summary_levels,
        risk_summary_first_transitions,
        first_hour_level_rows,
        normalized_texts,
        standardised_features,
        train_imputed,
        saved_model_predictions,
        situation_job_document,
    )
}

# Table of the vehicle report -> the registered query whose SQL it must equal.
_VEHICLE_TABLES = {
    "totals": "vehicle_totals",
    "composition": "vehicle_composition",
    "situations": "situation_summary",
    "weekdays": "weekday_summary",
    "daily_trend": "daily_trend",
}
QUERIES |= {
    f"vehicle_job_{name}": _vehicle_table(name, *(["share_percent"] if name == "composition" else []))
    for name in _VEHICLE_TABLES
}

_LONG = """
SELECT timestamp, sensor_id, speed FROM readings_wide
UNPIVOT INCLUDE NULLS (speed FOR sensor_id IN (click, error, purchase, signup, view))"""
_TYPES = "SELECT DISTINCT event_type AS sensor_id FROM events WHERE event_type IN ('click', 'error', 'view')"
# Null speeds: greatest() skips nulls in both engines, so such a cell has density 0.
_JOB = {"readings": _LONG, "sensors": _TYPES, "base": _BASE, "metrics": _METRICS}

ORACLES = {
    "file_readings": with_views("readings_wide", long=_LONG) + """
SELECT timestamp, sensor_id, round(speed, 8) AS speed FROM long""",
    "file_sensors": _TYPES,
    "file_edges": VIEWS["distances"],
    "file_junctions": VIEWS["junction_counts"],
    "file_roads": VIEWS["road_conditions"],
    "file_vehicles": _MIX_WITH + """
SELECT CAST(CarCount AS DOUBLE) AS CarCount, CAST(BikeCount AS DOUBLE) AS BikeCount,
  CAST(BusCount AS DOUBLE) AS BusCount, CAST(TruckCount AS DOUBLE) AS TruckCount,
  CAST(Total AS DOUBLE) AS Total, TrafficSituation, Time, Date, DayOfWeek FROM mix""",
    "sensor_job_summary": with_views("readings_wide", **_JOB, alerts=_ALERTS) + """
SELECT 'events' AS dataset, (SELECT count(*) FROM metrics) AS records_processed,
  (SELECT count(*) FROM alerts) AS congestion_alerts,
  (SELECT count(*) FROM metrics) AS forecast_records,
  (SELECT count(*) FROM metrics WHERE sd > 0 AND abs((speed - m) / sd) >= 2.5) AS anomalies_detected,
  (SELECT count(*) FROM metrics) AS pricing_records,
  (SELECT string_agg(sensor_id || ':' || events, ',' ORDER BY events DESC, sensor_id)
   FROM (SELECT sensor_id, count(*) AS events FROM alerts GROUP BY sensor_id
     ORDER BY events DESC, sensor_id LIMIT 10)) AS top_congested_sensors""",
    "sensor_job_alerts": with_views("readings_wide", **_JOB) + _ALERTS,
    "sensor_job_prices": with_views(
        "readings_wide", **_JOB, prices=_PRICES
    ) + "SELECT * FROM prices",
    "sensor_job_metrics": with_views("readings_wide", **_JOB) + """
SELECT timestamp, sensor_id, round(speed, 6) AS speed, round(free_flow_speed, 6) AS free_flow_speed,
  round(avg_speed_1h, 6) AS avg_speed_1h, round(speed_std_1h, 6) AS speed_std_1h,
  round(density_proxy, 6) AS density_proxy, density_score, congestion_level,
  travel_time_multiplier, hour_of_day, is_peak_period FROM metrics""",
    "sensor_job_forecast": with_views("readings_wide", **_JOB, trended=_TREND, forecast=_FORECAST) + """
SELECT * REPLACE (round(speed, 6) AS speed) FROM forecast""",
    "sensor_job_anomalies": with_views("readings_wide", **_JOB, anomalies=_ANOMALIES) + """
SELECT * REPLACE (round(speed, 6) AS speed, round(avg_speed_1h, 6) AS avg_speed_1h,
  round(speed_zscore, 6) AS speed_zscore) FROM anomalies""",
    "dashboard_choices": "SELECT sensor_id FROM (" + _TYPES + ")",
    "dashboard_history": with_views("readings_wide", **_JOB, trended=_TREND, forecast=_FORECAST) + """
SELECT timestamp, round(speed, 6) AS speed, forecast_speed FROM forecast WHERE sensor_id = 'click'""",
    "dashboard_fees": with_views("readings_wide", **_JOB, prices=_PRICES) + """
SELECT congestion_level, count(*) AS records, min(parking_fee_usd) AS min_fee,
  round(quantile_cont(parking_fee_usd, 0.25), 6) AS q1_fee,
  round(quantile_cont(parking_fee_usd, 0.5), 6) AS median_fee,
  round(quantile_cont(parking_fee_usd, 0.75), 6) AS q3_fee, max(parking_fee_usd) AS max_fee
FROM prices GROUP BY congestion_level""",
    "dashboard_charges": with_views("readings_wide", **_JOB, prices=_PRICES) + """
SELECT * FROM prices ORDER BY congestion_charge_usd DESC, timestamp, sensor_id LIMIT 20""",
    "dashboard_anomalies": with_views("readings_wide", **_JOB, anomalies=_ANOMALIES) + """
SELECT * REPLACE (round(speed, 6) AS speed, round(avg_speed_1h, 6) AS avg_speed_1h,
  round(speed_zscore, 6) AS speed_zscore) FROM anomalies ORDER BY timestamp DESC, sensor_id LIMIT 50""",
    "risk_job_rows": summary_queries.ORACLES["risk_intelligence"],
    "risk_job_levels": risk_with("report") + """
SELECT hour, risk_level, count(*) AS records, round(avg(traffic_volume), 8) AS avg_traffic_volume,
  round(avg(total_risk_score), 8) AS avg_total_risk_score FROM scored GROUP BY hour, risk_level""",
    "risk_job_transitions": risk_with("report", changes=_TRANSITIONS) + """
SELECT event_id, risk_level, previous_risk_level FROM changes ORDER BY date_time, event_id LIMIT 10""",
    **{f"vehicle_job_{name}": summary_queries.ORACLES[own] for name, own in _VEHICLE_TABLES.items()},
    "dashboard_most_congested": with_views("readings_wide", **_JOB) + """
SELECT sensor_id, timestamp, density_score FROM (SELECT * FROM metrics
  QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp DESC) = 1)
ORDER BY density_score DESC, sensor_id LIMIT 30""",
    "alert_counts": with_views("readings", "sensors", base=_BASE, metrics=_METRICS, alerts=_ALERTS)
    + "SELECT sensor_id, count(*) AS events FROM alerts GROUP BY sensor_id",
    "streamed_alerts": with_views(
        "readings", sensors="SELECT DISTINCT sensor_id FROM readings", base=_BASE, metrics=_METRICS
    ) + _ALERTS,
    "junction_summary_hourly": _FLAT_WITH + f"""
SELECT hour_of_day, {_TOTALS} FROM labeled GROUP BY hour_of_day ORDER BY hour_of_day LIMIT 12""",
    "junction_report_junctions": _PEAK_WITH + f"""
SELECT Junction, {_TOTALS}, avg(dynamic_fare) AS average_fare FROM labeled GROUP BY Junction""",
    "junction_report_bands": _PEAK_WITH + f"""
SELECT time_band, traffic_level, {_TOTALS} FROM labeled GROUP BY time_band, traffic_level""",
    "risk_summary_levels": risk_with("summary") + """
SELECT risk_level, count(*) AS records, round(avg(traffic_volume), 8) AS avg_traffic_volume,
  round(avg(visibility_in_miles), 8) AS avg_visibility_in_miles,
  round(avg(weather_severity), 8) AS avg_weather_severity,
  round(avg(total_risk_score), 8) AS avg_total_risk_score FROM scored GROUP BY risk_level""",
    "risk_summary_first_transitions": risk_with("summary") + _TRANSITIONS
    + "ORDER BY date_time, event_id LIMIT 10",
    "first_hour_level_rows": risk_with("report") + """
SELECT hour, risk_level, round(avg(traffic_volume), 8) AS avg_traffic,
  round(avg(visibility_in_miles), 8) AS avg_visibility,
  round(avg(weather_severity), 8) AS avg_weather, round(avg(total_risk_score), 8) AS avg_risk
FROM scored GROUP BY hour, risk_level ORDER BY hour, risk_level LIMIT 10""",
    "normalized_texts": with_views("road_conditions") + """
SELECT event_id, lower(trim(coalesce(weather_description, 'unknown'))) AS weather_description
FROM road_conditions""",
    "standardised_features": _risk_sql(
        ranked="""
SELECT weather_type, row_number() OVER (ORDER BY count(*) DESC, weather_type) AS place
FROM features GROUP BY weather_type""",
        numbers="SELECT avg(humidity) AS mh, stddev_samp(humidity) AS sh, avg(temperature) AS mt, "
        "stddev_samp(temperature) AS st FROM features",
    ) + f"""
SELECT event_id, {half_up("(humidity - mh) / sh", 6)} AS humidity,
  {half_up("(temperature - mt) / st", 6)} AS temperature,
  array_to_string([CASE WHEN r.place = i THEN 1 ELSE 0 END
    FOR i IN range(1, (SELECT count(*) + 1 FROM ranked))], ',') AS weather_type
FROM features JOIN ranked r USING (weather_type), numbers""",
    "train_imputed": with_views("road_conditions") + """
SELECT event_id,
  coalesce(visibility_in_miles, (SELECT quantile_disc(visibility_in_miles, 0.5) FROM road_conditions))
    AS visibility_in_miles,
  coalesce(air_pollution_index, (SELECT quantile_disc(air_pollution_index, 0.5) FROM road_conditions))
    AS air_pollution_index,
  coalesce(weather_description, (SELECT weather_description FROM road_conditions
    WHERE weather_description IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS weather_description
FROM road_conditions""",
}
