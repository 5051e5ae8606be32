"""Sensor speeds: metrics, alerts, forecast, anomalies, prices and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import half_up, view, with_views
from roadlens.operators import reshape, sensors
from roadlens.sources.sinks import nested


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    return sensors.sensor_facts(
        view(spark, folder, "readings"), sensors=view(spark, folder, "sensors")
    )


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Engines add doubles in different orders; compare to a fixed number of places."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def traffic_metrics(spark, folder):
    return rounded(
        sensors.traffic_metrics(_facts(spark, folder)), 8, "avg_speed_1h", "speed_std_1h",
        "density_proxy",
    )


def congestion_alerts(spark, folder):
    return sensors.congestion_alerts(_facts(spark, folder))


def speed_forecast(spark, folder):
    return sensors.speed_forecast(_facts(spark, folder))


def speed_anomalies(spark, folder):
    return rounded(
        sensors.speed_anomalies(_facts(spark, folder)), 8, "avg_speed_1h", "speed_zscore"
    )


def dynamic_prices(spark, folder):
    return sensors.dynamic_prices(_facts(spark, folder))


def run_counts(spark, folder):
    return sensors.run_counts(_facts(spark, folder))


def run_summary(spark, folder):
    facts = _facts(spark, folder)
    top = nested(sensors.top_sensors(sensors.congestion_alerts(facts)), "top")
    names = F.concat_ws(",", F.transform("top", lambda s: s["sensor_id"])).alias("top_sensors")
    most = F.array_max(F.transform("top", lambda s: s["events"])).alias("most_events")
    return top.select(names, most)


def top_congested_sensors(spark, folder):
    return sensors.top_sensors(congestion_alerts(spark, folder))


def latest_snapshot(spark, folder):
    metrics = sensors.traffic_metrics(_facts(spark, folder))
    return sensors.latest_snapshot(metrics).select("timestamp", "sensor_id", "speed")


def latest_per_sensor(spark, folder):
    metrics = sensors.traffic_metrics(_facts(spark, folder))
    return sensors.latest_per_sensor(metrics).select(
        "sensor_id", "timestamp", "speed", "density_score", "congestion_level"
    )


def most_congested_now(spark, folder):
    metrics = sensors.traffic_metrics(_facts(spark, folder))
    return sensors.most_congested_now(metrics).select(
        "sensor_id", "timestamp", "density_score", "congestion_level"
    )


def sensor_history(spark, folder):
    facts = _facts(spark, folder)
    worst = sensors.top_sensors(sensors.congestion_alerts(facts), 1)
    chosen = worst.select("sensor_id").scalar()
    return sensors.sensor_history(sensors.speed_forecast(facts), chosen)


def sensor_choices(spark, folder):
    return sensors.sensor_choices(speed_forecast(spark, folder))


def parking_fee_distribution(spark, folder):
    return rounded(
        sensors.parking_fee_distribution(dynamic_prices(spark, folder)),
        6, "q1_fee", "median_fee", "q3_fee",
    )


def top_charges(spark, folder):
    return sensors.top_charges(dynamic_prices(spark, folder))


def latest_anomalies(spark, folder):
    return sensors.latest_anomalies(speed_anomalies(spark, folder))


def wide_to_long(spark, folder):
    wide = view(spark, folder, "readings_wide")
    return rounded(reshape.wide_to_long(wide), 8, "speed")


QUERIES = {
    f.__name__: f
    for f in (
        traffic_metrics,
        congestion_alerts,
        speed_forecast,
        speed_anomalies,
        dynamic_prices,
        run_counts,
        run_summary,
        top_congested_sensors,
        latest_snapshot,
        latest_per_sensor,
        most_congested_now,
        sensor_history,
        sensor_choices,
        parking_fee_distribution,
        top_charges,
        latest_anomalies,
        wide_to_long,
    )
}

_BASE = """
SELECT r.timestamp, r.sensor_id, r.speed, f.free_flow_speed, f.m, f.sd,
  avg(r.speed) OVER w AS avg_speed_1h, coalesce(stddev_samp(r.speed) OVER w, 0.0) AS speed_std_1h,
  coalesce(r.speed - lag(r.speed) OVER (PARTITION BY r.sensor_id ORDER BY r.timestamp), 0.0) AS delta,
  CASE WHEN f.free_flow_speed > 0 THEN greatest(0.0, 1 - r.speed / f.free_flow_speed) ELSE 0.0 END
    AS density_proxy,
  CAST(hour(r.timestamp) AS INT) AS hour_of_day
FROM readings r JOIN sensors USING (sensor_id) JOIN (
  SELECT sensor_id, quantile_disc(speed, 0.95) AS free_flow_speed, avg(speed) AS m,
    coalesce(stddev_samp(speed), 0.0) AS sd
  FROM readings JOIN sensors USING (sensor_id) GROUP BY sensor_id) f USING (sensor_id)
WINDOW w AS (PARTITION BY r.sensor_id ORDER BY r.timestamp ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)
"""
_METRICS = f"""
SELECT *, {half_up("density_proxy * 100", 2)} AS density_score,
  CASE WHEN density_proxy >= 0.75 THEN 'severe' WHEN density_proxy >= 0.55 THEN 'high'
    WHEN density_proxy >= 0.30 THEN 'moderate' ELSE 'low' END AS congestion_level,
  {half_up("1 + density_proxy * 2.5", 3)} AS travel_time_multiplier,
  (hour_of_day BETWEEN 7 AND 10 OR hour_of_day BETWEEN 16 AND 19) AS is_peak_period
FROM base
"""
_ALERTS = """
SELECT timestamp, sensor_id, speed, free_flow_speed, density_score, congestion_level,
  travel_time_multiplier, is_peak_period
FROM metrics WHERE congestion_level IN ('high', 'severe') OR travel_time_multiplier >= 2.0
"""
_TREND = """
SELECT *, avg(delta) OVER (PARTITION BY sensor_id ORDER BY timestamp
  ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS trend FROM metrics
"""
_FORECAST = f"""
SELECT timestamp, sensor_id, speed, forecast_speed, forecast_density_score,
  CASE WHEN forecast_density_score >= 75 THEN 'severe' WHEN forecast_density_score >= 55 THEN 'high'
    WHEN forecast_density_score >= 30 THEN 'moderate' ELSE 'low' END AS forecast_congestion_level
FROM (SELECT *, {half_up("greatest(0.0, (1 - forecast_speed / free_flow_speed) * 100)", 2)}
    AS forecast_density_score
  FROM (SELECT *, {half_up("greatest(0.0, avg_speed_1h + trend * 3)", 2)} AS forecast_speed
    FROM trended))
"""
_ANOMALIES = """
SELECT timestamp, sensor_id, speed, round(avg_speed_1h, 8) AS avg_speed_1h,
  round(z, 8) AS speed_zscore,
  CASE WHEN speed < avg_speed_1h THEN 'sudden_slowdown' ELSE 'sensor_outlier' END AS anomaly_type,
  congestion_level
FROM (SELECT *, CASE WHEN sd > 0 THEN (speed - m) / sd ELSE 0.0 END AS z FROM metrics)
WHERE abs(z) >= 2.5
"""
_PRICES = f"""
SELECT timestamp, sensor_id, congestion_level, density_score,
  {half_up("density_score * 0.7::DOUBLE + hour_of_day * 0.8::DOUBLE", 2)} AS demand_index,
  {half_up("CASE WHEN is_peak_period THEN 1.2::DOUBLE ELSE 0.9::DOUBLE END + density_proxy * 0.35", 2)}
    AS public_transport_fare_multiplier,
  CASE congestion_level WHEN 'severe' THEN 12.0::DOUBLE WHEN 'high' THEN 8.0 WHEN 'moderate' THEN 4.0
    ELSE 1.5 END AS congestion_charge_usd,
  {half_up("2.0::DOUBLE + density_proxy * 5.0 + CASE WHEN is_peak_period THEN 1.5 ELSE 0.0 END", 2)}
    AS parking_fee_usd
FROM metrics
"""
_METRIC_WITH = with_views("readings", "sensors", base=_BASE, metrics=_METRICS)
_FORECAST_WITH = with_views(
    "readings", "sensors", base=_BASE, metrics=_METRICS, trended=_TREND, forecast=_FORECAST
)
_PRICE_WITH = with_views("readings", "sensors", base=_BASE, metrics=_METRICS, prices=_PRICES)

ORACLES = {
    "traffic_metrics": _METRIC_WITH + """
SELECT timestamp, sensor_id, speed, free_flow_speed, round(avg_speed_1h, 8) AS avg_speed_1h,
  round(speed_std_1h, 8) AS speed_std_1h, round(density_proxy, 8) AS density_proxy, density_score,
  congestion_level, travel_time_multiplier, hour_of_day, is_peak_period FROM metrics""",
    "congestion_alerts": _METRIC_WITH + _ALERTS,
    "speed_forecast": _FORECAST_WITH + "SELECT * FROM forecast",
    "speed_anomalies": _METRIC_WITH + _ANOMALIES,
    "dynamic_prices": _PRICE_WITH + "SELECT * FROM prices",
    "run_counts": _METRIC_WITH + """
SELECT count(*) AS records_processed,
  count(*) FILTER (congestion_level IN ('high', 'severe') OR travel_time_multiplier >= 2.0)
    AS congestion_alerts,
  count(*) AS forecast_records, count(*) FILTER (sd > 0 AND abs((speed - m) / sd) >= 2.5)
    AS anomalies_detected, count(*) AS pricing_records FROM metrics""",
    "run_summary": with_views(
        "readings", "sensors", base=_BASE, metrics=_METRICS, alerts=_ALERTS, top="""
SELECT sensor_id, count(*) AS events FROM alerts GROUP BY sensor_id
ORDER BY events DESC, sensor_id LIMIT 10"""
    ) + """
SELECT string_agg(sensor_id, ',' ORDER BY sensor_id) AS top_sensors, max(events) AS most_events
FROM top""",
    "top_congested_sensors": with_views(
        "readings", "sensors", base=_BASE, metrics=_METRICS, alerts=_ALERTS
    ) + """
SELECT sensor_id, count(*) AS events FROM alerts GROUP BY sensor_id
ORDER BY events DESC, sensor_id LIMIT 10""",
    "latest_snapshot": _METRIC_WITH + """
SELECT timestamp, sensor_id, speed FROM metrics
WHERE timestamp = (SELECT max(timestamp) FROM metrics)""",
    "latest_per_sensor": _METRIC_WITH + """
SELECT sensor_id, timestamp, speed, density_score, congestion_level FROM metrics
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp DESC) = 1""",
    "most_congested_now": _METRIC_WITH + """
SELECT sensor_id, timestamp, density_score, congestion_level FROM (SELECT * FROM metrics
  QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp DESC) = 1)
ORDER BY density_score DESC, sensor_id LIMIT 30""",
    "sensor_history": _FORECAST_WITH + """
SELECT timestamp, speed, forecast_speed FROM forecast WHERE sensor_id = (
  SELECT sensor_id FROM metrics
  WHERE congestion_level IN ('high', 'severe') OR travel_time_multiplier >= 2.0
  GROUP BY sensor_id ORDER BY count(*) DESC, sensor_id LIMIT 1)""",
    "sensor_choices": _FORECAST_WITH + "SELECT DISTINCT sensor_id FROM forecast",
    "parking_fee_distribution": _PRICE_WITH + """
SELECT congestion_level, count(*) AS records, min(parking_fee_usd) AS min_fee,
  round(quantile_cont(parking_fee_usd, 0.25), 6) AS q1_fee,
  round(quantile_cont(parking_fee_usd, 0.5), 6) AS median_fee,
  round(quantile_cont(parking_fee_usd, 0.75), 6) AS q3_fee, max(parking_fee_usd) AS max_fee
FROM prices GROUP BY congestion_level""",
    "top_charges": _PRICE_WITH + """
SELECT * FROM prices ORDER BY congestion_charge_usd DESC, timestamp, sensor_id LIMIT 20""",
    "latest_anomalies": with_views(
        "readings", "sensors", base=_BASE, metrics=_METRICS, anomalies=_ANOMALIES
    ) + "SELECT * FROM anomalies ORDER BY timestamp DESC, sensor_id LIMIT 50",
    "wide_to_long": with_views("readings_wide") + """
SELECT timestamp, sensor_id, round(speed, 8) AS speed FROM readings_wide
UNPIVOT INCLUDE NULLS (speed FOR sensor_id IN (click, error, purchase, signup, view))""",
}
